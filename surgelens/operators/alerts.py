"""Alert documents built from findings.

A document holds the findings of one run, which the run's top-k bounds; every
builder applies that bound again before it gathers anything.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.functions.scalars import MISSING
from surgelens.operators.scoring import run_summary
from surgelens.sources.baselines import KEYS

TITLE = "Log anomaly detected"

# The wording of chat messages and the names of the run's metrics.
QUIET = "No anomalies detected."
FINDING_TEXT = """*%d. Metric:* `%s`
*Key:* `%s`
*Subkey:* `%s`
*Value:* `%s`
*Score (Sigma):* `%s` (%s)
*Baseline Mean:* `%s`
*Baseline StdDev:* `%s`
"""
SOURCE_TEXT = "*Detection Time:* {timestamp}\n*Source:* {source}"
INDICATOR_TEXT = "*IOC Matches:* "
METRICS = ("AnomalyCount", "MaxAnomalyScore")

FIELDS = ("key", "subkey", "minute", "value", "score", "baseline_mean", "baseline_std", "metric", "mode", "ioc_matches")


def ranked(findings: DataFrame, top_k: int) -> DataFrame:
    """The strongest ``top_k`` findings as ``rank`` (from 1) and ``finding``.

    Ranking gathers at most ``top_k`` rows.
    """
    if "ioc_matches" not in findings.columns:
        findings = findings.withColumn("ioc_matches", F.lit(None).cast("array<string>"))
    strongest = findings.orderBy(F.abs("score").desc(), *KEYS, "minute").limit(top_k)
    order = F.struct(-F.abs("score"), *KEYS, "minute")
    gathered = strongest.agg(
        F.sort_array(F.collect_list(F.struct(order.alias("o"), F.struct(*FIELDS).alias("f")))).alias("all")
    )
    return gathered.select(
        F.inline(F.transform("all", lambda x, i: F.struct((i + 1).alias("rank"), x["f"].alias("finding"))))
    )


def _shown_value(value: Column) -> Column:
    whole = value == F.floor(value)
    return F.coalesce(F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string")), F.lit(MISSING))


def _two_digits(number: Column) -> Column:
    return F.when(number.isNull(), F.lit(MISSING)).otherwise(F.format_string("%.2f", number))


def _named(field: str) -> Column:
    return F.coalesce(F.col(f"finding.{field}").cast("string"), F.lit(MISSING))


def finding_text() -> Column:
    """One finding as chat text."""
    return F.format_string(
        FINDING_TEXT,
        F.col("rank"),
        _named("metric"),
        _named("key"),
        _named("subkey"),
        _shown_value(F.col("finding.value")),
        _two_digits(F.col("finding.score")),
        _named("mode"),
        _two_digits(F.col("finding.baseline_mean")),
        _two_digits(F.col("finding.baseline_std")),
    )


def alert_rows(findings: DataFrame, top_k: int) -> DataFrame:
    """Rank, chat text and indicator line of each finding."""
    matches = F.col("finding.ioc_matches")
    return ranked(findings, top_k).select(
        "rank",
        finding_text().alias("text"),
        F.when(F.size(matches) > 0, F.concat(F.lit(INDICATOR_TEXT), F.array_join(matches, ", "))).alias("ioc_text"),
    )


def chat_digest(findings: DataFrame, context: Mapping[str, str], top_k: int, title: str = TITLE) -> DataFrame:
    """One JSON message: header, source, a block per finding, dividers between."""
    divider = lambda: F.to_json(F.struct(F.lit("divider").alias("type")))

    def section(text: Column, kind: str = "section", form: str = "mrkdwn") -> Column:
        return F.to_json(
            F.struct(F.lit(kind).alias("type"), F.struct(F.lit(form).alias("type"), text.alias("text")).alias("text"))
        )

    indicator = F.to_json(
        F.struct(
            F.lit("context").alias("type"),
            F.array(F.struct(F.lit("mrkdwn").alias("type"), F.col("ioc_text").alias("text"))).alias("elements"),
        )
    )
    blocks = F.array_compact(
        F.array(section(F.col("text")), F.when(F.col("ioc_text").isNotNull(), indicator), divider())
    )
    per_finding = alert_rows(findings, top_k).select("rank", blocks.alias("blocks"))
    gathered = per_finding.agg(
        F.count(F.lit(1)).alias("n"),
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("rank", "blocks"))), lambda b: b["blocks"])).alias(
            "blocks"
        ),
    )
    header = F.concat(F.lit(f"🚨 {title} ("), F.col("n").cast("string"), F.lit(" findings) 🚨"))
    given = {name: context.get(name, MISSING) for name in ("timestamp", "source")}
    source = F.lit(SOURCE_TEXT.format(**given))
    opening = F.array(section(header, "header", "plain_text"), section(source), divider())
    body = F.concat(F.lit('{"blocks":['), F.array_join(F.concat(opening, F.col("blocks")), ","), F.lit("]}"))
    quiet = F.to_json(F.struct(F.lit(QUIET).alias("text")))
    return gathered.select(F.when(F.col("n") > 0, body).otherwise(quiet).alias("message"))


def alert_document(
    findings: DataFrame, context: Mapping[str, str], timestamp: str, top_k: int, title: str = TITLE
) -> DataFrame:
    """One JSON document with subject, findings in order, context and time."""
    gathered = ranked(findings, top_k).agg(
        F.count(F.lit(1)).alias("n"),
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "finding"))), lambda x: x["finding"]).alias("findings"),
    )
    subject = F.concat(F.lit(f"{title} ("), F.col("n").cast("string"), F.lit(" findings)"))
    named = [F.lit(v).alias(k) for k, v in context.items()] or [F.lit(None).cast("string").alias("source")]
    document = F.struct(
        subject.alias("subject"),
        F.col("findings"),
        F.struct(*named).alias("context"),
        F.lit(timestamp).alias("timestamp"),
    )
    return gathered.select(subject.alias("subject"), F.to_json(document).alias("message"))


def metric_record(
    findings: DataFrame, namespace: str, dimensions: Mapping[str, str], timestamp_ms: int
) -> DataFrame:
    """One embedded-metric JSON line with the run's two summary metrics."""
    units = F.array(
        *[F.struct(F.lit(n).alias("Name"), F.lit("Count").alias("Unit")) for n in METRICS]
    )
    directive = F.struct(
        F.lit(namespace).alias("Namespace"),
        F.array(F.array(*[F.lit(d) for d in dimensions])).alias("Dimensions"),
        units.alias("Metrics"),
    )
    record = F.struct(
        F.struct(
            F.lit(timestamp_ms).cast("bigint").alias("Timestamp"), F.array(directive).alias("CloudWatchMetrics")
        ).alias("_aws"),
        *[F.lit(v).alias(k) for k, v in dimensions.items()],
        F.col("anomaly_count").alias(METRICS[0]),
        F.col("max_anomaly_score").alias(METRICS[1]),
    )
    return run_summary(findings).select(F.to_json(record).alias("record"))
