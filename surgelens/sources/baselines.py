"""Persisted baselines: appended run deltas over a compacted snapshot.

A run writes only the series it touched, below ``delta/run_id=<id>``; repeating
a run replaces its own directory. Reading keeps the newest row of each series.
Compaction writes ``base/run_id=<id>`` covering all runs up to that id, so a
read scans one base and the deltas after it. Run ids must sort in run order.

A store with ``buckets`` deals every run's series to that many files by their hash.
Reading, compaction and the join with a cycle's series then move no saved row; the
number belongs to the store and is written down with it.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from surgelens.sources.schemas import BASELINE
from surgelens.sources.storage import committed, exists, remove

KEYS = ["metric", "key", "subkey"]
FIELDS = [n for n in BASELINE.fieldNames() if n not in KEYS]
SERIES = StructType([BASELINE[k] for k in KEYS])
BUCKETED = StructType(
    [StructField("series", SERIES), *(BASELINE[n] for n in FIELDS), StructField("kind", StringType()), StructField("run", StringType())]
)


def completed(rows: DataFrame) -> DataFrame:
    """Baselines from elsewhere, which may carry no more than mean and std."""
    missing = [f for f in BASELINE.fields if f.name in FIELDS and f.name not in rows.columns]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}) if missing else rows


def series_of(*keys: Column | str) -> Column:
    """The ``series`` struct of its keys, of the type that saved rows have: one whose
    keys can't be null would be cast for the join, and so shuffled once more."""
    return F.struct(*keys).cast(SERIES)


def keyed_rows(rows: DataFrame) -> DataFrame:
    return rows if "series" in rows.columns else rows.withColumn("series", series_of(*KEYS)).drop(*KEYS)


def newest_by_series(rows: DataFrame) -> DataFrame:
    """Newest row by run id of each ``series`` struct, as ``b``.

    Combines map-side: a task sends one row per series, however many runs it read.
    """
    latest = F.max_by(F.struct(*FIELDS), F.struct("run_id", "last_updated"))
    return keyed_rows(completed(rows)).groupBy("series").agg(latest.alias("b"))


def newest_per_series(rows: DataFrame) -> DataFrame:
    return newest_by_series(rows).select("series.*", "b.*")


def of_active_series(rows: DataFrame, active: DataFrame) -> DataFrame:
    """Rows of series that occur in ``active``.

    A cycle touches few of the series ever seen. While their keys are small
    enough to broadcast, the other baselines never leave the scan; otherwise
    this join's shuffle is the one that the later steps build on.
    """
    wanted = active.select(series_of(*KEYS).alias("series")).distinct()
    return keyed_rows(rows).join(wanted, "series", "left_semi")


def upsert(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """All series of both sides; a series in ``fresh`` replaces the stored one."""
    new = fresh.select(*KEYS, F.struct(*FIELDS).alias("new"))
    old = stored.select(*KEYS, F.struct(*FIELDS).alias("old"))
    return old.join(new, KEYS, "full_outer").select(*KEYS, F.coalesce("new", "old").alias("b")).select(*KEYS, "b.*")


class BaselineStore:
    """Saved baselines below ``path``.

    ``buckets`` is set when a store is first written (None: not bucketed) and read
    back later; another number for the same store is an error. Joins move nothing of
    the other side either if it equals ``spark.sql.shuffle.partitions``.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        self.root = path.rstrip("/")
        self.buckets = self._layout(buckets)
        self.base = f"{self.root}/kind=base" if self.buckets else f"{self.root}/base"
        self.delta = f"{self.root}/kind=delta" if self.buckets else f"{self.root}/delta"
        self.key = "run" if self.buckets else "run_id"

    def _layout(self, buckets: int | None) -> int | None:
        """The number of buckets the store was written with."""
        note = f"{self.root}/_buckets"
        if exists(self.spark, f"{note}/_SUCCESS"):
            written = int(self.spark.read.text(note).first()["value"])
            if buckets not in (None, written):
                raise ValueError(f"{self.root} has {written} buckets")
            return written
        if buckets:
            if exists(self.spark, f"{self.root}/base") or exists(self.spark, f"{self.root}/delta"):
                raise ValueError(f"{self.root} was written without buckets")
            self.spark.createDataFrame([(str(buckets),)], "value string").write.mode("overwrite").text(note)
        return buckets

    def _table(self) -> DataFrame:
        """All runs as one catalog table, which is how Spark learns of the buckets."""
        name = f"baselines_{hashlib.md5(self.root.encode()).hexdigest()}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in BUCKETED.fields)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY (kind, run)"
            f" CLUSTERED BY (series) SORTED BY (series) INTO {self.buckets} BUCKETS LOCATION :location",
            args={"location": self.root},
        )
        self.spark.catalog.recoverPartitions(name)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], BASELINE)
        if not self.buckets:
            return self.spark.read.schema(BASELINE).parquet(*folders)
        return self._table().where(self._wanted(folders)).drop("kind", "run")

    def _wanted(self, folders: list[str]) -> Column:
        """A filter on the partition columns, so only these folders are scanned."""
        named = [folder[len(self.root) + 1 :].split("/") for folder in folders]
        wanted = F.lit(False)
        for kind in ("base", "delta"):
            runs = [run.removeprefix("run=") for of, run in named if of == f"kind={kind}"]
            if runs:
                wanted = wanted | ((F.col("kind") == kind) & F.col("run").isin(runs))
        return wanted

    def _folders(self, before: str | None) -> list[str]:
        bases = [r for r in committed(self.spark, self.base, self.key) if before is None or r < before]
        floor = bases[-1] if bases else ""
        runs = [
            r
            for r in committed(self.spark, self.delta, self.key)
            if r > floor and (before is None or r < before)
        ]
        return [self._folder(self.base, r) for r in bases[-1:]] + [self._folder(self.delta, r) for r in runs]

    def _folder(self, kind: str, run_id: str) -> str:
        return f"{kind}/{self.key}={run_id}"

    def history(self, before: str | None = None) -> DataFrame:
        """The newest base and the deltas after it, a series once per run,
        optionally only from runs before an id."""
        return self._read(self._folders(before))

    def load(self, before: str | None = None) -> DataFrame:
        """Newest baseline of each series."""
        folders = self._folders(before)
        rows = self._read(folders)
        if len(folders) > 1:
            return newest_per_series(rows)
        return rows.select("series.*", *FIELDS) if "series" in rows.columns else rows

    def append(self, rows: DataFrame, run_id: str) -> None:
        """Save a run's baselines. The row keeps its run id, so base rows do too."""
        if not run_id or not all(ch.isalnum() or ch in "-_." for ch in run_id):
            raise ValueError("run ids are letters, digits, '-', '_' and '.'")
        stamped = rows.withColumn("run_id", F.lit(run_id)).select(*BASELINE.fieldNames())
        self._save(stamped, self.delta, run_id)

    def _save(self, rows: DataFrame, folder: str, run_id: str) -> None:
        """Write a run's folder. Reads know finished ones by their marker, so a cluster
        that writes none would lose them silently: that is an error."""
        target = self._folder(folder, run_id)
        if self.buckets:
            self._save_bucketed(rows, target)
        else:
            rows.write.mode("overwrite").parquet(target)
        if not exists(self.spark, f"{target}/_SUCCESS"):
            raise RuntimeError("baselines need _SUCCESS markers; set mapreduce.fileoutputcommitter.marksuccessfuljobs")

    def _save_bucketed(self, rows: DataFrame, target: str) -> None:
        """One file per bucket. Bucket numbers are in the files' names, so the table
        that names them needn't stay."""
        name = f"baselines_{uuid.uuid4().hex}"
        dealt = keyed_rows(rows).select("series", *FIELDS).repartition(self.buckets, "series")
        writer = dealt.write.format("parquet").bucketBy(self.buckets, "series").sortBy("series")
        try:
            writer.option("path", target).mode("overwrite").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def open_runs(self) -> int:
        """How many runs the newest base doesn't cover."""
        return sum(f.startswith(f"{self.delta}/") for f in self._folders(None))

    def compact(self) -> str | None:
        """Fold all deltas into a new base; returns its id, None if there is none.

        A base that covers the newest run stays as it is: it must not be written
        over while it is read. What the base before this one covers is removed, so
        listings stay short; runs since that base stay, for a run that is repeated
        reads the baselines from before itself.
        """
        runs = committed(self.spark, self.delta, self.key)
        if not runs:
            return None
        if runs[-1] in committed(self.spark, self.base, self.key):
            return runs[-1]
        bases = committed(self.spark, self.base, self.key)
        self._save(self.load(), self.base, runs[-1])
        if bases:
            for old in bases[:-1]:
                remove(self.spark, self._folder(self.base, old))
            for run in runs:
                if run <= bases[-1]:
                    remove(self.spark, self._folder(self.delta, run))
        return runs[-1]
