"""Tumbling and sliding counts over a stream, with a bound on lateness."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surgelens.sources.storage import committed


def windowed_counts(
    stream: DataFrame,
    ts: str,
    keys: Sequence[str],
    width: str = "1 minute",
    slide: str | None = None,
    late: str = "15 minutes",
) -> DataFrame:
    """Counts per window and key; a window is emitted once nothing can reach it.

    Records later than ``late`` behind the newest are dropped, so state holds
    open windows only.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    span = F.window(ts, width, slide) if slide else F.window(ts, width)
    return (
        timed.groupBy(span.alias("w"), *keys)
        .agg(F.count(F.lit(1)).alias("value"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "value")
    )


def to_parquet(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to Parquet, on a schedule or (``every=None``) until it is drained."""
    writer = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


MARK = "newest bigint, cutoff bigint, n_rows bigint, n_late bigint"


def accounted_counts(
    stream: DataFrame,
    ts: str,
    keys: Sequence[str],
    path: str,
    checkpoint: str,
    width: str = "1 minute",
    late_minutes: int = 15,
    every: str | None = None,
    then: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Tumbling counts that account for every row of a stream.

    ``windowed_counts`` drops what comes behind its watermark. Here a batch's rows
    are split at the cutoff, ``late_minutes`` before the newest time of all batches
    before it: rows from the cutoff on are counted, the others (and rows without a
    time) are written to a table of their own, whole. A window that ends at or
    before the new cutoff is closed, since no later row can be counted into it.

    Below ``path``, each with a folder per batch that a repeated batch replaces:
    ``late`` (the refused rows), ``state`` (window counts, ``closed`` or still open)
    and ``marks`` (newest time, cutoff, rows and refused rows, as observed while
    the batch was written). A batch reads the open windows of the one before it,
    so what is carried on is as large as the open windows are many.

    ``then`` is called with the windows that a batch closed and its number, and again
    with the same ones if the batch is repeated. Over batches, closed windows come in
    the order of time.
    """
    spark, root = stream.sparkSession, path.rstrip("/")
    late_us = late_minutes * 60_000_000

    def account(batch: DataFrame, number: int) -> None:
        before = [b for b in committed(spark, f"{root}/marks", "batch") if int(b) < number]
        last = max(before, key=int) if before else None
        mark = spark.read.schema(MARK).parquet(f"{root}/marks/batch={last}").first() if last else None
        newest, cutoff = (mark["newest"], mark["newest"] - late_us if mark["newest"] is not None else None) if mark else (None, None)
        at = F.unix_micros(F.col(f"`{ts}`").cast("timestamp"))
        refused = at.isNull() if cutoff is None else at.isNull() | (at < cutoff)
        rows = batch.persist()
        try:
            seen = Observation()
            watched = rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(refused).alias("n_late"), F.max(at).alias("newest"))
            watched.where(refused).write.mode("overwrite").parquet(f"{root}/late/batch={number}")
            found = seen.get
            tops = [x for x in (newest, found["newest"]) if x is not None]
            top = max(tops) if tops else None
            span = F.window(F.col(f"`{ts}`").cast("timestamp"), width)
            counts = rows.where(~refused).groupBy(span.alias("w"), *keys).agg(F.count(F.lit(1)).alias("value"))
            counts = counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "value")
            if last is not None:
                counts = counts.unionByName(open_counts(spark, root, int(last), counts.schema))
            total = counts.groupBy("window_start", "window_end", *keys).agg(F.sum("value").alias("value"))
            closed = F.lit(False) if top is None else F.unix_micros("window_end") <= top - late_us
            total.withColumn("closed", closed).write.mode("overwrite").partitionBy("closed").parquet(f"{root}/state/batch={number}")
            marks = [(top, cutoff, found["n_rows"], found["n_late"])]
            spark.createDataFrame(marks, MARK).coalesce(1).write.mode("overwrite").parquet(f"{root}/marks/batch={number}")
            if then is not None:
                then(_state(spark, [f"{root}/state/batch={number}"], root, True, total.schema), number)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(account).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def _state(spark: SparkSession, folders: list[str], root: str, closed: bool, schema=None) -> DataFrame:
    reader = spark.read.option("basePath", f"{root}/state")
    if schema is not None:
        names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        reader = reader.schema(f"{names}, batch int, closed boolean")
    return reader.parquet(*folders).where(F.col("closed") == closed).drop("closed", "batch")


def open_counts(spark: SparkSession, path: str, batch: int | None = None, schema=None) -> DataFrame:
    """Windows that were still open after a batch, by default the last one."""
    root = path.rstrip("/")
    number = batch if batch is not None else max(map(int, committed(spark, f"{root}/marks", "batch")))
    return _state(spark, [f"{root}/state/batch={number}"], root, False, schema)


def closed_counts(spark: SparkSession, path: str) -> DataFrame:
    """Closed windows of all batches; a window is closed once."""
    root = path.rstrip("/")
    folders = [f"{root}/state/batch={b}" for b in committed(spark, f"{root}/marks", "batch")]
    return _state(spark, folders, root, True)


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """The refused rows of all batches, with the ``batch`` that refused them."""
    root = path.rstrip("/")
    folders = [f"{root}/late/batch={b}" for b in committed(spark, f"{root}/marks", "batch")]
    return spark.read.option("basePath", f"{root}/late").parquet(*folders)
