"""Baselines carried across micro-batches.

``scored_stream`` keeps each series' state in the stream's state store and
scores points as they come. ``scheduled_cycles`` instead runs the batch plan on
every micro-batch against the saved baselines.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from surgelens.operators.series import to_points
from surgelens.params import DetectionParams
from surgelens.plans.detection import detect_and_tag
from surgelens.sources.baselines import KEYS, BaselineStore, of_active_series
from surgelens.sources.indicators import Indicators
from surgelens.sources.sinks import write_findings
from surgelens.sources.storage import exists

SCORED = (
    "metric string, key string, subkey string, minute timestamp, value double,"
    " score double, baseline_mean double, baseline_std double"
)
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SeriesScorer(StatefulProcessor):
    """Folds the closed minutes of one series into five numbers.

    The state goes once the stream's time is ``idle_minutes`` past its last
    minute: a timer is kept for the newest minute only.
    """

    def __init__(self, alpha: float, min_count: int, idle_minutes: int):
        self.alpha, self.min_count, self.idle_ms = alpha, min_count, idle_minutes * 60_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("series", "n bigint, mean double, c double, q double, last bigint")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sums = pd.Series(dtype="float64")
        for piece in rows:
            sums = sums.add(piece.groupby("minute")["value"].sum(), fill_value=0.0)
        n, mean, c, q, last = self.state.get() if self.state.exists() else (0, 0.0, 0.0, 1.0, None)
        known, keep, out = last, 1.0 - self.alpha, []
        if last is not None and last + self.idle_ms <= timerValues.getCurrentWatermarkInMs():
            # Its timer is due in this batch: what comes now comes after it.
            n, mean, c, q, last = 0, 0.0, 0.0, 1.0, None
        for minute, x in sums.sort_index().items():
            at = minute.value // 1_000_000
            if last is not None and at <= last:
                continue
            std = math.sqrt(c / (1.0 - q)) if n >= 2 and q < 1.0 else None
            score = None
            if std is not None and n >= self.min_count:
                score = (x - mean) / std if std else 0.0
            out.append((*key, minute, x, score, mean if n else None, std))
            if n == 0:
                mean = x
            else:
                d = x - mean
                mean, c, q = mean + self.alpha * d, keep * (c + self.alpha * d * d), keep * keep * q + self.alpha**2
            n, last = n + 1, at
        if last is not None and last != known:
            if known is not None:
                self.handle.deleteTimer(known + self.idle_ms)
            self.handle.registerTimer(last + self.idle_ms)
            self.state.update((n, float(mean), float(c), float(q), last))
        yield pd.DataFrame(out, columns=[*KEYS, "minute", "value", "score", "baseline_mean", "baseline_std"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def scored_stream(points: DataFrame, params: DetectionParams, idle_minutes: int = 7 * 24 * 60, late: str = "0 minutes") -> DataFrame:
    """Every point of a stream with its score against the state before it.

    A micro-batch hands a series its points in pieces; a minute's values are summed
    piece by piece, so a batch holds one number for each of its minutes. Minutes
    must be closed when they come, as those of ``windowed_counts`` are: rows at or
    before a series' newest folded minute, or more than ``late`` behind the
    stream's newest at the end of the batch before, are too late and left out
    (``accounted_counts`` keeps such rows). State per series is five numbers and
    goes ``idle_minutes`` after the series' last one; a series that comes back
    later starts anew. The state store is RocksDB, so it needn't fit in memory.
    """
    points.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    ready = to_points(points, carried=()).select(*KEYS, "minute", "value").withWatermark("minute", late)
    scorer = SeriesScorer(params.alpha, params.min_count, idle_minutes)
    return ready.groupBy(*KEYS).transformWithStateInPandas(scorer, SCORED, "Append", "EventTime")


def first_start(spark: SparkSession, checkpoint: str) -> str:
    """When the stream of a checkpoint first started; kept in a folder beside it."""
    path = f"{checkpoint.rstrip('/')}-since"
    if not exists(spark, f"{path}/_SUCCESS"):
        now = dt.datetime.now(dt.timezone.utc)
        spark.createDataFrame([(f"{now:%Y%m%dT%H%M%S%f}",)], "value string").write.mode("overwrite").text(path)
    return spark.read.text(path).first()["value"]


def resume(
    points: DataFrame, run_id: str, params: DetectionParams, store: BaselineStore, findings_path: str, indicators: Indicators | None
) -> None:
    """Detection on one batch of points and the baselines saved before it."""
    stored = of_active_series(store.history(before=run_id), points)
    found = detect_and_tag(points, params, indicators, stored)
    write_findings(found.findings, findings_path, run_id)
    store.append(found.baselines, run_id)


def scheduled_cycles(
    points: DataFrame,
    params: DetectionParams,
    store: BaselineStore,
    findings_path: str,
    checkpoint: str,
    indicators: Indicators | None = None,
    once: bool = False,
) -> StreamingQuery:
    """Detection on every micro-batch of hotspot rows, each on the saved baselines.

    Run ids are the stream's first start and the batch number: a batch replayed
    after a failure reads the baselines from before itself and replaces its own
    outputs, and a stream with a new checkpoint sorts after all earlier ones.
    """
    since = first_start(points.sparkSession, checkpoint)

    def cycle(batch: DataFrame, number: int) -> None:
        run_id = f"{since}-{number:012d}"
        points = to_points(batch).persist()
        try:
            resume(points, run_id, params, store, findings_path, indicators)
        finally:
            points.unpersist()

    writer = points.writeStream.foreachBatch(cycle).option("checkpointLocation", checkpoint)
    every = f"{params.every_minutes} minutes"
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)
    return writer.start()
