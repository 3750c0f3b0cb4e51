"""Counts per minute and entity, and their top-k lists.

Raw rows meet only partial aggregation before the one shuffle, so an address
that owns a third of the log costs one row per group and input task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.functions.scalars import epoch_millis_to_ts, epoch_seconds_to_ts, first_label, minute_of
from surgelens.functions.scalars import header_value
from surgelens.operators.slices import recent as recent_rows

# Metric and source names.
REQUESTS, FLOWS = "request_count", "connection_count"
WAF, VPC = "WAF", "VPC"
UNION_COLUMNS = ["minute", "key", "subkey", "country", "rule_label", "value", "metric", "source_type"]


def count_groups(df: DataFrame, keys: Sequence[Column | str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("value"))


def top_by_value(df: DataFrame, k: int, ties: Sequence[str]) -> DataFrame:
    """The k largest values; ties fall to the smaller keys, NULL first."""
    return df.orderBy(F.desc("value"), *[F.asc_nulls_first(c) for c in ties]).limit(k)


def drop_open_minute(counts: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Leave out the minute that was still running at ``as_of``."""
    moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    return counts.where(F.col("minute") < F.date_trunc("minute", F.lit(moment.isoformat()).cast("timestamp")))


def waf_counts(logs: DataFrame, as_of: dt.datetime, minutes: int, with_ua: bool = False) -> DataFrame:
    """Requests per minute, address, URI, country and first label, and user agent
    if wanted: every agent keeps its own count, and all combine by hash map-side."""
    recent = recent_rows(logs, "timestamp", 1000, as_of, minutes)
    keys = [
        minute_of(epoch_millis_to_ts(F.col("timestamp"))).alias("minute"),
        F.col("httpRequest.clientIp").alias("key"),
        F.col("httpRequest.uri").alias("subkey"),
        F.col("httpRequest.country").alias("country"),
        first_label(F.col("labels")).alias("rule_label"),
    ]
    if with_ua:
        keys.append(header_value(F.col("httpRequest.headers"), "User-Agent").alias("ua"))
    return count_groups(recent, keys).withColumn("metric", F.lit(REQUESTS))


def vpc_counts(logs: DataFrame, as_of: dt.datetime, minutes: int, extra: Sequence[str] = ()) -> DataFrame:
    """Flows per minute, source address and target port, and any ``extra`` columns."""
    recent = recent_rows(logs, "start", 1, as_of, minutes)
    keys = [
        minute_of(epoch_seconds_to_ts(F.col("start"))).alias("minute"),
        F.col("srcaddr").alias("key"),
        F.col("dstport").alias("subkey"),
        *extra,
    ]
    return count_groups(recent, keys).withColumn("metric", F.lit(FLOWS))


def waf_hotspots(logs: DataFrame, as_of: dt.datetime, minutes: int, top_k: int) -> DataFrame:
    counts = waf_counts(logs, as_of, minutes)
    return top_by_value(counts, top_k, ["minute", "key", "subkey", "country", "rule_label"])


def vpc_hotspots(logs: DataFrame, as_of: dt.datetime, minutes: int, top_k: int) -> DataFrame:
    counts = vpc_counts(logs, as_of, minutes, extra=["protocol", "action"])
    return top_by_value(counts, top_k, ["minute", "key", "subkey", "protocol", "action"])


def _largest_groups(counts: DataFrame, k: int, keys: Sequence[str]) -> DataFrame:
    """Rows of the k largest groups, whatever finer columns the rows have."""
    if set(counts.columns) - {*keys, "value", "metric", "source_type"} == set():
        return top_by_value(counts, k, keys)
    best = top_by_value(counts.groupBy(*keys).agg(F.sum("value").alias("value")), k, keys)
    best = F.broadcast(best.select(*[F.col(c).alias(f"_{c}") for c in keys]))  # k rows
    same = [counts[c].eqNullSafe(best[f"_{c}"]) for c in keys]
    return counts.join(best, same, "left_semi")


def union_counts(
    waf: DataFrame,
    vpc: DataFrame,
    as_of: dt.datetime,
    minutes: int,
    top_k: int | None,
    with_ua: bool = False,
    closed: bool = False,
) -> DataFrame:
    """Both sources in one schema; with ``top_k``, each source keeps its k largest.

    ``closed`` counts the ``minutes`` whole minutes before ``as_of``, before any
    limit: neither the first nor the last of them is cut.
    """
    if closed:
        as_of = as_of.replace(second=0, microsecond=0)
    nothing = F.lit(None).cast("string")
    requests = waf_counts(waf, as_of, minutes, with_ua).withColumn("source_type", F.lit(WAF))
    flows = vpc_counts(vpc, as_of, minutes).withColumns(
        {
            "subkey": F.col("subkey").cast("string"),
            "country": nothing,
            "rule_label": nothing,
            "source_type": F.lit(VPC),
        }
    )
    if closed:
        requests, flows = drop_open_minute(requests, as_of), drop_open_minute(flows, as_of)
    columns = list(UNION_COLUMNS)
    if with_ua:
        flows = flows.withColumn("ua", nothing)
        columns.append("ua")
    if top_k is not None:
        requests = _largest_groups(requests, top_k, ["minute", "key", "subkey", "country", "rule_label"])
        flows = top_by_value(flows, top_k, ["minute", "key", "subkey"])
    return requests.select(columns).unionByName(flows.select(columns))


def union_hotspots(waf: DataFrame, vpc: DataFrame, as_of: dt.datetime, minutes: int, top_k: int) -> DataFrame:
    return union_counts(waf, vpc, as_of, minutes, top_k).orderBy("minute", "source_type", F.desc("value"))
