"""Points grouped into series and folded into baseline states.

A series has one point for each minute: counts of a minute that differ in country,
label or user agent are summed before anything is folded.

A long series is cut into blocks of time. Each block is gathered, sorted and
summarised on its own, so no row ever holds more than one block of one series;
the summaries (five numbers per block) are then chained in time order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from surgelens.functions import smoothing as S
from surgelens.functions.scalars import number_or_zero, or_missing
from surgelens.sources.baselines import KEYS, series_of

CARRIED = ("country", "ua", "rule_label", "source_type")
# What stays with a point once a minute's counts are summed: a metric has one source.
KEPT = ("source_type",)


def to_points(df: DataFrame, carried: Sequence[str] = CARRIED) -> DataFrame:
    """Normalise hotspot-like rows: typed minute and value, never-NULL keys.

    Columns missing from the input become NULL; values may be strings.
    """
    have = set(df.columns)
    is_text = dict(df.dtypes)["value"] == "string"
    value = number_or_zero(F.col("value")) if is_text else F.coalesce(F.col("value").cast("double"), F.lit(0.0))
    subkey = or_missing(F.col("subkey")) if "subkey" in have else or_missing(F.lit(None))
    extra = [(F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in carried]
    return df.select(
        or_missing(F.col("metric")).alias("metric"),
        or_missing(F.col("key")).alias("key"),
        subkey.alias("subkey"),
        F.col("minute").cast("timestamp").alias("minute"),
        value.alias("value"),
        *extra,
    )


def _point(carried: Sequence[str]) -> Column:
    return F.expr(f"struct({', '.join(['minute', 'value', *carried])})")


def per_minute(points: DataFrame) -> DataFrame:
    """One point for each series and minute: the sum of the minute's counts."""
    return points.groupBy(*KEYS, "minute").agg(F.sum("value").alias("value"))


def latest_point(points: DataFrame) -> DataFrame:
    """Newest minute and its sum per series, without gathering the series.

    Both steps keep fixed-width buffers, so they hash and combine map-side.
    """
    newest = per_minute(points).groupBy(*KEYS)
    return newest.agg(F.max("minute").alias("minute"), F.max_by("value", "minute").alias("value"))


def _passed(points: DataFrame) -> list[Column]:
    """A ``stored`` column, the series' saved baseline, goes along unchanged."""
    return [F.any_value("stored").alias("stored")] if "stored" in points.columns else []


def keyed(points: DataFrame) -> DataFrame:
    """Points with their keys as one ``series`` struct.

    A single column stays recognisable as the partitioning even where some of
    the keys are constants that the optimizer folds away.
    """
    if "series" in points.columns:
        return points
    return points.withColumn("series", series_of(*KEYS)).drop(*KEYS)


def by_series(points: DataFrame) -> DataFrame:
    """The one shuffle of a fold: later grouping by series, with or without
    block, and windows over a series' blocks stay inside this partitioning.

    Points are sums of a minute, made inside that partitioning, so a busy series is
    as long as its time span, however many rows and groups it stands for.
    """
    if "series" in points.columns:
        return points
    dealt = keyed(points).repartition("series")
    kept = [c for c in KEPT if c in dealt.columns]
    return dealt.groupBy("series", "minute", *kept).agg(F.sum("value").alias("value"))


def with_gaps(points: DataFrame, step_minutes: int) -> DataFrame:
    """Adds ``gap``: silent steps before each point, since the one before it or the
    series' saved baseline. Stays inside the partitioning by series."""
    before = F.lag("minute").over(Window.partitionBy("series").orderBy("minute"))
    if "stored" in points.columns:
        before = F.coalesce(before, F.col("stored.last_minute"))
    away = F.call_function("div", F.unix_seconds("minute") - F.unix_seconds(before), F.lit(step_minutes * 60)) - 1
    return points.withColumn("gap", F.coalesce(F.greatest(away, F.lit(0).cast("bigint")), F.lit(0).cast("bigint")))


def with_silence(points: DataFrame, until: Column, baselines: DataFrame | None = None) -> DataFrame:
    """Points, and a 0 at ``until`` for every series in them or among ``baselines``:
    a series that has a point there gets no other sum by it."""
    source = F.any_value("source_type", True).alias("source_type")
    known = points.groupBy(*KEYS).agg(source)
    if baselines is not None:
        names = "series.*" if "series" in baselines.columns else "*"
        saved = baselines.select(names).select(*KEYS).distinct().join(known.select(*KEYS), KEYS, "left_anti")
        known = known.unionByName(saved.withColumn("source_type", F.lit(None).cast("string")))
    zeros = known.withColumns({"minute": until, "value": F.lit(0.0)})
    others = [c for c in points.columns if c not in zeros.columns]
    return points.unionByName(zeros.withColumns({c: F.lit(None).cast(points.schema[c].dataType) for c in others}))


FIRST_VALUE = "element_at(points, 1).value"
LAST_POINT = "element_at(points, -1)"
BUT_LAST = "slice(points, 1, size(points) - 1)"


def to_blocks(
    points: DataFrame, alpha: float, block_minutes: int, carried: Sequence[str] = KEPT, silent_step: int | None = None
) -> DataFrame:
    """One row per series and block: sorted points, their summary (``summary``)
    and the summary of all but the last (``before``).

    With ``silent_step`` (minutes) the steps without a point count as 0.
    """
    gaps = silent_step is not None
    if gaps:
        points, carried = with_gaps(points, silent_step), (*carried, "gap")
    block = F.floor(F.unix_seconds("minute") / F.lit(block_minutes * 60)).alias("block")
    gathered = points.groupBy("series", block).agg(
        F.sort_array(F.collect_list(_point(carried))).alias("points"), *_passed(points)
    )
    before = gathered.withColumn("before", F.expr(S.block_summary(BUT_LAST, alpha, gaps)))
    return before.withColumn("summary", F.expr(S.after_gap("before", LAST_POINT, alpha, gaps)))


def _flat_keys(rows: DataFrame) -> DataFrame:
    return rows.select("series.*", *[c for c in rows.columns if c != "series"])


def _start(rows: DataFrame, head: str, alpha: float) -> str:
    fresh = S.first_state(head, alpha)
    return f"coalesce(stored.state, {fresh})" if "stored" in rows.columns else fresh


def series_tails(
    points: DataFrame,
    alpha: float,
    block_minutes: int,
    carried: Sequence[str] = KEPT,
    silent_step: int | None = None,
) -> DataFrame:
    """Per series: the newest point, the state before it and the state after it."""
    blocks = to_blocks(by_series(points), alpha, block_minutes, carried, silent_step)
    part = f"struct(block, {FIRST_VALUE} AS head, summary, before, {LAST_POINT} AS newest)"
    chained = blocks.groupBy("series").agg(
        F.sort_array(F.collect_list(F.expr(part))).alias("parts"), *_passed(blocks)
    )
    carry = S.apply_blocks(
        _start(chained, "element_at(parts, 1).head", alpha), "slice(parts, 1, size(parts) - 1)", alpha
    )
    states = chained.withColumns({"carry": F.expr(carry), "last": F.element_at("parts", -1)}).withColumns(
        {
            "point": F.col("last.newest"),
            "prior": F.expr(S.apply_block("carry", "last.before", alpha)),
            "post": F.expr(S.apply_block("carry", "last.summary", alpha)),
        }
    )
    if silent_step is not None:
        states = states.withColumn("prior", F.expr(S.silent("prior", "point.gap", alpha)))
    return _flat_keys(states.drop("parts", "carry", "last"))


def _started_blocks(
    points: DataFrame, alpha: float, block_minutes: int, carried: Sequence[str], silent_step: int | None
) -> DataFrame:
    """Blocks with the running state at their start, from the earlier summaries.

    A block gets the summaries of all blocks before it: five numbers for each
    ``block_points`` minutes, so a year in minutes has 53. Within these bounds the
    list is quadratic in the number of blocks, not in that of points.
    """
    blocks = to_blocks(by_series(points), alpha, block_minutes, carried, silent_step)
    before = Window.partitionBy("series").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.collect_list(F.expr(f"struct({FIRST_VALUE} AS head, summary)")).over(before)
    rows = blocks.withColumn("earlier", earlier)
    first = f"coalesce(get(earlier, 0).head, {FIRST_VALUE})"
    return rows.withColumn("start", F.expr(S.apply_blocks(_start(rows, first, alpha), "earlier", alpha)))


def point_states(
    points: DataFrame,
    alpha: float,
    block_minutes: int,
    carried: Sequence[str] = KEPT,
    silent_step: int | None = None,
) -> DataFrame:
    """Every point with the state before it (``prior``) and after it (``post``)."""
    started = _started_blocks(points, alpha, block_minutes, carried, silent_step)
    scored = "transform(points, (p, i) -> struct(p AS point, get(states, i) AS prior, get(states, i + 1) AS post))"
    states = started.withColumn("states", F.expr(S.all_states("points", alpha, "start", silent_step is not None)))
    rows = states.select("series.*", F.inline(F.expr(scored)))
    return rows if silent_step is None else rows.withColumn("prior", F.expr(S.silent("prior", "point.gap", alpha)))


def smoothed(points: DataFrame, alpha: float, block_minutes: int) -> DataFrame:
    """Weighted mean and deviation after every point."""
    rows = point_states(points, alpha, block_minutes, carried=())
    return rows.select(
        *KEYS,
        F.col("point.minute").alias("minute"),
        F.col("point.value").alias("value"),
        F.col("post.mean").alias("ewma"),
        F.expr(S.state_std("post")).alias("ewma_std"),
    )
