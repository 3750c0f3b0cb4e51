"""Sinks for findings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.sources.schemas import FINDING


def write_findings(findings: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """One directory per run, so that a repeated run replaces its own output."""
    stamped = findings.withColumn("dt", F.date_format("minute", "yyyy-MM-dd"))
    stamped.write.partitionBy("dt").mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/run_id={run_id}")


def read_findings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Saved findings of all runs, also when no run found anything."""
    return spark.read.schema(FINDING).format(fmt).load(path)
