"""From landed log files to findings in one stream.

New files of both log tables are one stream of rows; their minutes are counted as
``accounted_counts`` does, and each batch's closed minutes are one detection cycle
on the baselines of the cycles before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surgelens.functions.scalars import epoch_millis_to_ts, epoch_seconds_to_ts, first_label, header_value
from surgelens.operators.hotspots import FLOWS, REQUESTS, VPC, WAF
from surgelens.operators.series import to_points
from surgelens.params import DetectionParams
from surgelens.sources import schemas
from surgelens.sources.baselines import BaselineStore
from surgelens.sources.indicators import Indicators
from surgelens.sources.logs import canonical_vpc, canonical_waf
from surgelens.streaming.baseline import first_start, resume
from surgelens.streaming.counts import accounted_counts

GROUPS = ["metric", "key", "subkey", "country", "rule_label", "ua", "source_type"]


def landed_rows(spark: SparkSession, waf_path: str, vpc_path: str) -> DataFrame:
    """A stream of what is counted of both logs, a row for each record, with its time.

    Lines that are no record have no time, and so are refused by the counts.
    """
    nothing = F.lit(None).cast("string")
    waf = canonical_waf(spark.readStream.schema(schemas.WAF).json(waf_path)).select(
        epoch_millis_to_ts(F.col("timestamp")).alias("at"),
        F.lit(REQUESTS).alias("metric"),
        F.col("httpRequest.clientIp").alias("key"),
        F.col("httpRequest.uri").alias("subkey"),
        F.col("httpRequest.country").alias("country"),
        first_label(F.col("labels")).alias("rule_label"),
        header_value(F.col("httpRequest.headers"), "User-Agent").alias("ua"),
        F.lit(WAF).alias("source_type"),
    )
    vpc = canonical_vpc(spark.readStream.schema(schemas.VPC).json(vpc_path)).select(
        epoch_seconds_to_ts(F.col("start")).alias("at"),
        F.lit(FLOWS).alias("metric"),
        F.col("srcaddr").alias("key"),
        F.col("dstport").cast("string").alias("subkey"),
        nothing.alias("country"),
        nothing.alias("rule_label"),
        nothing.alias("ua"),
        F.lit(VPC).alias("source_type"),
    )
    return waf.unionByName(vpc)


def landing_cycles(
    spark: SparkSession,
    waf_path: str,
    vpc_path: str,
    params: DetectionParams,
    store: BaselineStore,
    counts_path: str,
    findings_path: str,
    checkpoint: str,
    indicators: Indicators | None = None,
    late_minutes: int = 15,
    once: bool = False,
) -> StreamingQuery:
    """Detection over log files as they land, every ``every_minutes``; ``once`` drains
    what is there.

    A minute is scored once, when nothing can be counted into it any more; rows that
    come too late for theirs are kept below ``counts_path``, as ``late_rows`` reads
    them. The cutoff follows the newest row of both logs, so ``late_minutes`` must
    cover how far one may lag behind the other. A batch that is repeated reads the
    baselines from before itself and replaces its own counts, findings and baselines.
    """
    since = first_start(spark, checkpoint)

    def cycle(closed: DataFrame, number: int) -> None:
        points = to_points(closed.withColumnRenamed("window_start", "minute"))
        resume(points, f"{since}-{number:012d}", params, store, findings_path, indicators)
        if store.open_runs() >= params.compact_every:
            store.compact()

    every = None if once else f"{params.every_minutes} minutes"
    rows = landed_rows(spark, waf_path, vpc_path)
    return accounted_counts(rows, "at", GROUPS, counts_path, checkpoint, "1 minute", late_minutes, every, cycle)
