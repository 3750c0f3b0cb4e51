"""JSON to Parquet conversion, partition by partition, with a manifest of source
files, and retention."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.sources.storage import committed, list_files, list_partitions

# Columnar files of about this many rows; a larger hour is split over several.
ROWS_PER_FILE = 5_000_000


def in_partitions(pairs: Iterable[tuple[str, str]]) -> Column:
    """Predicate on (dt, hr) that prunes to exactly the given partitions."""
    by_day: dict[str, list[str]] = {}
    for day, hour in pairs:
        by_day.setdefault(day, []).append(hour)
    keep = F.lit(False)
    for day, hours in sorted(by_day.items()):
        keep = keep | ((F.col("dt") == day) & F.col("hr").isin(sorted(hours)))
    return keep


def write_partitioned(logs: DataFrame, path: str, mode: str = "append", fmt: str = "parquet") -> None:
    """Write by (dt, hr). Rebalancing splits an oversized hour and merges small ones."""
    writer = (
        logs.hint("rebalance", "dt", "hr")
        .write.partitionBy("dt", "hr")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .mode("overwrite" if mode == "replace" else mode)
    )
    if mode == "replace":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if fmt == "json":
        writer = writer.option("compression", "gzip")
    writer.format(fmt).save(path)


MANIFEST = "file string, size bigint, modified bigint, dt string, hr string"


def _manifest(target: str) -> str:
    """Beside the converted hours; scans of ``target`` pass over names that begin so."""
    return f"{target.rstrip('/')}/_manifest"


def converted_files(spark: SparkSession, target: str) -> DataFrame:
    """The source files that finished runs have converted into ``target``."""
    root = _manifest(target)
    runs = [f"{root}/run={r}" for r in committed(spark, root, "run")]
    return spark.read.schema(MANIFEST).parquet(*runs) if runs else spark.createDataFrame([], MANIFEST)


def _record(spark: SparkSession, files: DataFrame, target: str) -> None:
    """Note the files of a finished conversion, in a folder that only then is complete."""
    files.write.parquet(f"{_manifest(target)}/run={uuid.uuid4().hex}")


def _listed(spark: SparkSession, source: str) -> DataFrame:
    return spark.createDataFrame(list_files(spark, source, "dt", "hr"), MANIFEST)


def convert_day(
    spark: SparkSession,
    read: Callable[[SparkSession, str], DataFrame],
    source: str,
    target: str,
    day: str,
    mode: str = "append",
) -> int:
    """Convert one day's partitions; returns how many (0: nothing to do).

    ``mode="append"`` adds to what is there, ``mode="replace"`` rewrites the
    touched partitions and so may be repeated after a lost run.
    """
    dt.date.fromisoformat(day)
    files = _listed(spark, source).where(F.col("dt") == day)
    pairs = [tuple(r) for r in files.select("dt", "hr").distinct().collect()]
    if pairs:
        write_partitioned(read(spark, source).where(in_partitions(pairs)), target, mode)
        _record(spark, files, target)
    return len(pairs)


def convert_new(
    spark: SparkSession, read: Callable[[SparkSession, str], DataFrame], source: str, target: str
) -> int:
    """Convert the hours that hold a file which no run has converted; returns how many.

    Such an hour is rewritten whole. A manifest names the files (path, size, time)
    that were listed before the write, so one that lands while a run is under way is
    new to the next run, whether this one's scan met it or not, and its rows end
    up in the target once. A run that is lost before its manifest is written is
    simply done again. An hour that was converted from files which are gone can't
    be rewritten without loss: that is an error, and nothing is written.
    """
    files = _listed(spark, source)
    known = converted_files(spark, target)
    fresh = files.join(known, ["file", "size", "modified"], "left_anti").select("dt", "hr").distinct()
    pairs = sorted(tuple(r) for r in fresh.collect())
    if not pairs:
        return 0
    touched = in_partitions(pairs)
    gone = known.where(touched).select("file").distinct().join(files, "file", "left_anti").limit(3).collect()
    if gone:
        raise RuntimeError(f"converted before, but gone from the source: {[r['file'] for r in gone]}")
    write_partitioned(read(spark, source).where(touched), target, "replace")
    _record(spark, files.where(touched), target)
    return len(pairs)


def expired_partitions(partitions: DataFrame, as_of: dt.date, keep_days: int) -> DataFrame:
    """Days older than the retention, with the rows they hold."""
    oldest = (as_of - dt.timedelta(days=keep_days)).isoformat()
    return partitions.where(F.col("dt") < oldest).groupBy("dt").agg(F.count(F.lit(1)).alias("n_rows"))


def expired_days(spark: SparkSession, path: str, as_of: dt.date, keep_days: int) -> list[str]:
    """The same days from the folder names alone, without opening a file."""
    oldest = (as_of - dt.timedelta(days=keep_days)).isoformat()
    return [day for (day,) in list_partitions(spark, path, "dt") if day < oldest]
