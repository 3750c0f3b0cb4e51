"""Session settings, shared scratch space and broadcast bounds."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Upper bound, in bytes, for driver-built tables that may be broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024


def build_session(app: str = "surgelens", master: str | None = None, cpus: int = 8) -> SparkSession:
    """A session for local runs; on a cluster the submitter's settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.sql.shuffle.partitions", str(cpus))
                # Folds cost more per byte than other stages: keep all cores busy.
                .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
                .config("spark.driver.memory", "8g")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.host", "127.0.0.1")
            )
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        # Call sites in error messages cost several calls per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def utc(spark: SparkSession) -> SparkSession:
    """Log times are UTC; pin the session so that casts and formats agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_dirs: dict[str, str] = {}


def _named_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder, one per session.
    """
    named = _named_dir(spark)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="surgelens-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, never cleared."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of its own below the shared folder: what several later
    steps read is worked out once, and outlives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_within(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast only if the known size is inside the bound.

    Beyond it the plain join stands and Spark shuffles both sides.
    """
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df
