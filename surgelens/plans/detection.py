"""One detection cycle: count, score, tag, save, render."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.functions.scalars import or_missing
from surgelens.operators.alerts import alert_document, metric_record
from surgelens.operators.hotspots import union_counts
from surgelens.operators.indicators import tag_findings
from surgelens.operators.scoring import Detection, detect_anomalies, fresh_enough, train_baselines
from surgelens.operators.series import to_points
from surgelens.params import DetectionParams
from surgelens.session import written
from surgelens.sources.baselines import KEYS, BaselineStore, keyed_rows, of_active_series
from surgelens.sources.indicators import Indicators
from surgelens.sources.sinks import read_findings, write_findings
from surgelens.sources.storage import committed

# Namespace of the summary metrics, and findings in an alert if all are reported.
NAMESPACE = "surgelens"
ALERTED = 100
# Run ids are a cycle's ``as_of``, as Python and Spark write it.
RUN_ID, RUN_ID_TIME = "%Y%m%dT%H%M%S", "yyyyMMdd'T'HHmmss"


def cycle_points(
    waf: DataFrame, vpc: DataFrame, as_of: dt.datetime, params: DetectionParams, hotspot_limit: int | None = -1
) -> DataFrame:
    """The counts a cycle scores, by country, label and user agent.

    ``hotspot_limit`` (default: the parameter's) keeps that many per source.
    """
    limit = params.hotspot_limit if hotspot_limit == -1 else hotspot_limit
    return union_counts(
        waf, vpc, as_of, params.lookback_minutes, limit, with_ua=True, closed=params.drop_open_minute
    )


def plan_cycle(
    waf: DataFrame,
    vpc: DataFrame,
    as_of: dt.datetime,
    params: DetectionParams,
    indicators: Indicators | None = None,
    baselines: DataFrame | None = None,
    hotspot_limit: int | None = -1,
) -> Detection:
    """A cycle that saves nothing but its own steps; see ``detect_and_tag``."""
    counts = written(cycle_points(waf, vpc, as_of, params, hotspot_limit), "counts")
    return detect_and_tag(to_points(counts), params, indicators, baselines)


def detect_and_tag(
    counts: DataFrame,
    params: DetectionParams,
    indicators: Indicators | None = None,
    baselines: DataFrame | None = None,
    until: dt.datetime | None = None,
) -> Detection:
    """Tagged findings and new baselines of saved counts, which are folded once.

    The fold is written down, as both results read it; so are the findings, which
    tagging reads three times. Patterns run over findings only, never over counts.
    """
    found = detect_anomalies(counts, params, baselines, keep=written, until=until)
    findings = written(found.findings, "untagged")
    return Detection(tag_findings(findings, indicators, counts), found.baselines)


def saved_counts(
    spark: SparkSession, points_path: str, as_of: dt.datetime, params: DetectionParams, wanted: DataFrame | None = None
) -> DataFrame | None:
    """Counts saved by the cycles of the last ``train_days``, found by folder name.

    Lookbacks overlap; a group's newest count of a minute is the one that stays.
    ``wanted`` (``series`` structs) leaves the other series in the scan. None if
    there is no such cycle.
    """
    root = points_path.rstrip("/")
    oldest, now = f"{as_of - dt.timedelta(days=params.train_days):{RUN_ID}}", f"{as_of:{RUN_ID}}"
    runs = [f"{root}/run_id={r}" for r in committed(spark, root, "run_id") if oldest <= r < now]
    if not runs:
        return None
    rows = spark.read.option("basePath", root).parquet(*runs)
    groups = [c for c in rows.columns if c not in ("value", "run_id")]
    if wanted is not None:
        series = F.struct(*[or_missing(F.col(k)).alias(k) for k in KEYS])
        rows = rows.withColumn("series", series).join(wanted, "series", "left_semi").drop("series")
    run = F.unix_timestamp(F.col("run_id").cast("string"), RUN_ID_TIME)
    return rows.groupBy(*groups).agg(F.max_by("value", run).alias("value"))


def refreshed(
    stored: DataFrame, counts: DataFrame, points_path: str, as_of: dt.datetime, params: DetectionParams
) -> DataFrame:
    """``stored`` without stale baselines; series of ``counts`` that then lack one get
    one trained from the counts of earlier cycles.

    Earlier counts are opened only if there is such a series, and only for such.
    """
    fresh = fresh_enough(stored, as_of, params.max_age_days)
    lacking = counts.select(F.struct(*KEYS).alias("series")).distinct().join(fresh.select("series"), "series", "left_anti")
    wanted = written(lacking, "untrained")
    if wanted.isEmpty():
        return fresh
    earlier = saved_counts(counts.sparkSession, points_path, as_of, params, wanted)
    if earlier is None:
        return fresh
    return fresh.unionByName(keyed_rows(train_baselines(to_points(earlier), params, as_of)))


def run_cycle(
    waf: DataFrame,
    vpc: DataFrame,
    as_of: dt.datetime,
    params: DetectionParams,
    store: BaselineStore,
    points_path: str,
    findings_path: str,
    indicators: Indicators | None = None,
    hotspot_limit: int | None = -1,
    alerts_path: str | None = None,
) -> str:
    """Run a cycle and save its counts, findings and baselines; returns the run id.

    With ``alerts_path``, the alert document and the summary metric of the saved
    findings are written below it.

    The counts are saved first, so the logs are scanned once for all results,
    and stay as history to train on (``max_age_days``). Ids follow ``as_of``, and all outputs
    replace their own directory, so a cycle cut short can simply be run again.
    """
    run_id = f"{as_of:{RUN_ID}}"
    spark = waf.sparkSession
    points = f"{points_path.rstrip('/')}/run_id={run_id}"
    cycle_points(waf, vpc, as_of, params, hotspot_limit).write.mode("overwrite").parquet(points)
    counts = to_points(spark.read.parquet(points))
    until, stored = None, store.history(before=run_id)
    if params.silence == "zero":
        # Also series that this run has no count of are scored, on the newest whole minute.
        until = as_of.replace(second=0, microsecond=0) - dt.timedelta(minutes=1)
    else:
        stored = of_active_series(stored, counts)
    if params.max_age_days is not None:
        stored = refreshed(stored, counts, points_path, as_of, params)
    found = detect_and_tag(counts, params, indicators, stored, until)
    write_findings(found.findings, findings_path, run_id)
    store.append(found.baselines, run_id)
    if store.open_runs() >= params.compact_every:
        store.compact()
    if alerts_path is not None:
        saved = read_findings(spark, findings_path).where(F.col("run_id") == run_id).drop("run_id")
        render(saved, alerts_path, run_id, as_of, params)
    return run_id


def render(findings: DataFrame, path: str, run_id: str, as_of: dt.datetime, params: DetectionParams) -> None:
    """Write a run's alert document and metric record as one line of JSON each."""
    moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    limit = params.top_k or ALERTED
    document = alert_document(findings, {"run_id": run_id}, f"{moment:%Y-%m-%dT%H:%M:%SZ}", limit)
    metric = metric_record(findings, NAMESPACE, {"run_id": run_id}, int(moment.timestamp() * 1000))
    root = path.rstrip("/")
    document.select(F.col("message").alias("value")).write.mode("overwrite").text(f"{root}/alerts/run_id={run_id}")
    metric.select(F.col("record").alias("value")).write.mode("overwrite").text(f"{root}/metrics/run_id={run_id}")
