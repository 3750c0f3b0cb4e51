"""Step changes by cumulative sums.

A spike stands out from its baseline at once; a small lasting shift doesn't, but
its deviations add up. Two one-sided sums of each series, of ``z - drift`` above
its target and of ``-z - drift`` below, alarm beyond ``limit`` and start anew.

Series are cut into blocks of time as for baselines: blocks are summarised apart,
starts are chained through the summaries, and every block is then listed from its
start, so no row holds more than one block of a series. All steps stay inside
the one shuffle that deals points by series.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from surgelens.functions import cumulative as C
from surgelens.functions.smoothing import double
from surgelens.operators.series import by_series, to_points
from surgelens.sources.baselines import KEYS, keyed_rows


@dataclass(frozen=True)
class ChangeParams:
    """``drift`` and ``limit`` are in deviations of the target."""

    drift: float = 0.5
    limit: float = 5.0
    block_minutes: int = 7 * 24 * 60

    def __post_init__(self) -> None:
        if self.drift < 0 or self.limit <= 0 or self.block_minutes <= 0:
            raise ValueError("drift must not be negative; limit and block_minutes must be positive")


SIDES = ("up", "down")


def _with_targets(points: DataFrame, targets: DataFrame | None, states: DataFrame | None) -> DataFrame:
    """Points of a series with its target (default: its own mean and deviation) and,
    if it has a saved state, the sums it starts from, without points folded before."""
    ready = by_series(points)
    if targets is None:
        whole = Window.partitionBy("series")
        target = F.struct(F.avg("value").over(whole).alias("mean"), F.stddev_samp("value").over(whole).alias("std"))
        ready = ready.withColumn("target", target)
    else:
        known = keyed_rows(targets.select(*KEYS, F.struct("mean", "std").alias("target")))
        ready = ready.join(known, "series")
    if states is None:
        return ready.withColumn("start", F.expr("named_struct('up', 0D, 'down', 0D)"))
    saved = keyed_rows(states.select(*KEYS, F.struct("up", "down").alias("saved"), "last_minute"))
    joined = ready.join(saved, "series", "left").where("last_minute IS NULL OR minute > last_minute")
    return joined.withColumn("start", F.expr("coalesce(saved, named_struct('up', 0D, 'down', 0D))")).drop("saved", "last_minute")


def cumulative_sums(
    points: DataFrame, params: ChangeParams, targets: DataFrame | None = None, states: DataFrame | None = None
) -> DataFrame:
    """Every point with ``z``, both sums after it and, where one passed the limit,
    ``alarm`` ('up', 'down' or 'both') and ``reached``, the larger of those sums.

    ``targets`` (mean and std per series, as baselines have them) replaces the
    series' own; points of series that it lacks are left out. A target without a
    deviation, or with 0, never alarms. ``states`` continues where ``change_states``
    ended. Points of a minute are summed first, and a null value counts as 0.
    """
    ready = _with_targets(to_points(points, carried=()), targets, states)
    z = F.expr("CASE WHEN target.std > 0 THEN (value - target.mean) / target.std ELSE 0D END")
    block = F.floor(F.unix_seconds("minute") / F.lit(params.block_minutes * 60)).alias("block")
    point = F.struct("minute", "value", z.alias("z"))
    blocks = ready.groupBy("series", block).agg(F.sort_array(F.collect_list(point)).alias("points"), F.any_value("start").alias("start"))
    steps = {"up": f"p.z - {double(params.drift)}", "down": f"-p.z - {double(params.drift)}"}
    for side in SIDES:
        blocks = blocks.withColumn(side, F.expr(C.summary(f"transform(points, p -> {steps[side]})", params.limit)))
    before = Window.partitionBy("series").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    chained = blocks.withColumn("earlier", F.collect_list(F.struct(*SIDES)).over(before))
    begin = {s: f"aggregate(earlier, start.{s}, (s, b) -> {C.applied('s', f'b.{s}')})" for s in SIDES}
    started = chained.select("series", "points", F.expr(f"named_struct('up', {begin['up']}, 'down', {begin['down']}, 'r_up', 0D, 'r_down', 0D)").alias("start"))
    raw = {s: f"(state.{s} + {steps[s].replace('p.z', 'item.z')})" for s in SIDES}
    after = ", ".join(f"'{s}', {C.moved(f'state.{s}', steps[s].replace('p.z', 'item.z'), params.limit)}" for s in SIDES)
    grown = f"named_struct({after}, 'r_up', {raw['up']}, 'r_down', {raw['down']})"
    states_ = started.withColumn("states", F.expr(C.listed("points", "start", grown)))
    rows = states_.select("series.*", F.inline(F.expr("transform(points, (p, i) -> struct(p.minute, p.value, p.z, get(states, i + 1) AS state))")))
    up, down = (F.col(f"state.r_{s}") > params.limit for s in SIDES)
    alarm = F.when(up & down, "both").when(up, "up").when(down, "down")
    return rows.select(
        *KEYS, "minute", "value", "z", "state.up", "state.down", alarm.alias("alarm"),
        F.when(up | down, F.greatest("state.r_up", "state.r_down")).alias("reached"),
    )


def change_alarms(points: DataFrame, params: ChangeParams, targets: DataFrame | None = None, states: DataFrame | None = None) -> DataFrame:
    """The points at which a sum passed the limit."""
    return cumulative_sums(points, params, targets, states).where("alarm IS NOT NULL")


def change_states(sums: DataFrame) -> DataFrame:
    """Where every series stands after ``cumulative_sums``: what a later run starts from."""
    newest = F.max_by(F.struct("up", "down"), "minute").alias("s")
    return sums.groupBy(*KEYS).agg(newest, F.max("minute").alias("last_minute")).select(*KEYS, "s.*", "last_minute")
