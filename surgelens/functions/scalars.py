"""Small column helpers for nested log records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "N/A"


def epoch_seconds_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def epoch_millis_to_ts(millis: Column) -> Column:
    """Millisecond epochs lose their fraction, as integer division does."""
    return F.timestamp_seconds(F.call_function("div", millis, F.lit(1000)))


def minute_of(ts: Column) -> Column:
    return F.date_trunc("minute", ts)


def day_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hour_label(ts: Column) -> Column:
    return F.date_format(ts, "HH")


def header_value(headers: Column, name: str) -> Column:
    """Value of the first header called ``name``; NULL if there is none."""
    hits = F.filter(headers, lambda h: h["name"] == F.lit(name))
    return F.get(hits, F.lit(0))["value"]


def first_label(labels: Column) -> Column:
    return F.get(labels, F.lit(0))["name"]


def number_or_zero(text: Column) -> Column:
    """Lenient number parsing: anything that is not a number counts as 0.

    Type suffixes, which the cast would take (``1d``), are no numbers here.
    """
    number = F.when(~text.rlike(r"[0-9.][dDfF]\s*\z"), text.try_cast("double"))
    return F.when(F.isnan(number), F.lit(0.0)).otherwise(F.coalesce(number, F.lit(0.0)))


def or_missing(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(MISSING))


def feature_key(parts: Sequence[Column]) -> Column:
    """Parts joined by ``|``; a NULL part keeps its place as an empty string."""
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
