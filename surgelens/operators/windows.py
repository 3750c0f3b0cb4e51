"""Sliding counts over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pane_counts(df: DataFrame, ts: Column, keys: Sequence[str], minutes: int) -> DataFrame:
    """Tumbling counts: one row per pane of ``minutes`` and key."""
    return df.groupBy(F.window(ts, f"{minutes} minutes")["start"].alias("pane"), *keys).agg(
        F.count(F.lit(1)).alias("value")
    )


def sliding_counts(
    df: DataFrame, ts: Column, keys: Sequence[str], window_minutes: int = 15, slide_minutes: int = 5
) -> DataFrame:
    """Counts of every window of ``window_minutes`` starting each ``slide_minutes``.

    Rows are first counted per slide-wide pane; only the pane counts are then
    copied into the windows that contain them, never the rows.
    """
    if window_minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    panes = pane_counts(df, ts, keys, slide_minutes)
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(window_minutes // slide_minutes - 1)),
        lambda i: F.timestamp_seconds(F.unix_seconds("pane") - i * F.lit(slide_minutes * 60)),
    )
    return (
        panes.select(F.explode(starts).alias("window_start"), *keys, "value")
        .groupBy("window_start", *keys)
        .agg(F.sum("value").alias("value"))
    )
