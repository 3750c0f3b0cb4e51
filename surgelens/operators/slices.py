"""Time slices: partition predicates, event-time filters and flat log views."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from surgelens.functions.scalars import epoch_millis_to_ts, epoch_seconds_to_ts, first_label, header_value

UTC = dt.timezone.utc


def _aware(moment: dt.datetime) -> dt.datetime:
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def _epoch(moment: dt.datetime) -> float:
    return _aware(moment).timestamp()


def partition_range(as_of: dt.datetime, lookback_minutes: int) -> Column:
    """Predicate on (dt, hr) covering the lookback, also across midnight."""
    end = _aware(as_of)
    start = end - dt.timedelta(minutes=lookback_minutes)
    day, hour = F.col("dt"), F.col("hr")
    d0, h0, d1, h1 = (f"{start:%Y-%m-%d}", f"{start:%H}", f"{end:%Y-%m-%d}", f"{end:%H}")
    return (
        (day >= d0) & (day <= d1) & ((day > d0) | (hour >= h0)) & ((day < d1) | (hour <= h1))
    )


def within_epoch(column: Column, as_of: dt.datetime, lookback_minutes: int, per_second: int) -> Column:
    """Lookback on a raw epoch column, so that the scan can skip row groups.

    Epochs count whole seconds here: a millisecond column is compared as if its
    fraction had been cut off first.
    """
    end = _epoch(as_of)
    first = math.ceil(end - lookback_minutes * 60)
    return (column >= first * per_second) & (column < (math.floor(end) + 1) * per_second)


def lookback(df: DataFrame, column: str, as_of: dt.datetime, minutes: int) -> DataFrame:
    """Rows of the last ``minutes`` up to ``as_of``, for either timestamp type.

    The bounds are literals of the column's own type and reach the scan.
    """
    kind = "timestamp_ntz" if isinstance(df.schema[column].dataType, TimestampNTZType) else "timestamp"
    end = _aware(as_of)
    start = end - dt.timedelta(minutes=minutes)

    def bound(moment: dt.datetime) -> Column:
        text = moment.replace(tzinfo=None).isoformat(sep=" ")
        return F.lit(text if kind == "timestamp_ntz" else text + "+00:00").cast(kind)

    return df.where((F.col(column) >= bound(start)) & (F.col(column) <= bound(end)))


def recent(logs: DataFrame, column: str, per_second: int, as_of: dt.datetime, minutes: int) -> DataFrame:
    """Rows of the lookback by an epoch column, and by partition where there are any."""
    rows = logs.where(within_epoch(F.col(column), as_of, minutes, per_second))
    return rows.where(partition_range(as_of, minutes)) if {"dt", "hr"} <= set(logs.columns) else rows


def slice_waf(logs: DataFrame, as_of: dt.datetime, minutes: int = 120) -> DataFrame:
    """Web requests as flat rows."""
    return recent(logs, "timestamp", 1000, as_of, minutes).select(
        epoch_millis_to_ts(F.col("timestamp")).alias("event_time"),
        F.col("httpRequest.clientIp").alias("client_ip"),
        F.col("httpRequest.country").alias("country"),
        header_value(F.col("httpRequest.headers"), "User-Agent").alias("user_agent"),
        F.col("httpRequest.uri").alias("uri"),
        F.col("terminatingRule.action").alias("rule_action"),
        F.col("terminatingRule.ruleId").alias("rule_id"),
        first_label(F.col("labels")).alias("label"),
    )


def slice_vpc(logs: DataFrame, as_of: dt.datetime, minutes: int = 120) -> DataFrame:
    """Network flows as flat rows."""
    return recent(logs, "start", 1, as_of, minutes).select(
        epoch_seconds_to_ts(F.col("start")).alias("start_time"),
        epoch_seconds_to_ts(F.col("end")).alias("end_time"),
        "srcaddr",
        "dstaddr",
        "srcport",
        "dstport",
        "protocol",
        "packets",
        "bytes",
        "action",
        "log_status",
    )


def register_views(waf: DataFrame, vpc: DataFrame, as_of: dt.datetime, minutes: int = 120) -> None:
    slice_waf(waf, as_of, minutes).createOrReplaceTempView("slice_waf")
    slice_vpc(vpc, as_of, minutes).createOrReplaceTempView("slice_vpc")
