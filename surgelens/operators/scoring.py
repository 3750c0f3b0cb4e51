"""Baselines, anomaly scores and findings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.functions import smoothing as S
from surgelens.operators.series import by_series, point_states, series_tails, to_points, with_silence
from surgelens.params import DetectionParams
from surgelens.sources.baselines import KEYS, newest_by_series

# Fixed value: a deviation below this counts as this.
STD_FLOOR = 1e-6


class Detection(NamedTuple):
    findings: DataFrame
    baselines: DataFrame


def train_baselines(points: DataFrame, params: DetectionParams, as_of: dt.datetime | None = None) -> DataFrame:
    """Mean and deviation of each series: (x, 0) for one point, else the final fold.

    With ``as_of``, only the last ``train_days`` count.
    """
    points = to_points(points)
    if as_of is not None:
        moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
        end = F.lit(moment.isoformat()).cast("timestamp")
        first = F.lit((moment - dt.timedelta(days=params.train_days)).isoformat()).cast("timestamp")
        points = points.where((F.col("minute") >= first) & (F.col("minute") <= end))
    tails = series_tails(points, params.alpha, params.block_minutes, carried=(), silent_step=params.silent_step)
    return _as_baselines(tails, F.col("post.mean"), F.expr(f"coalesce({S.state_std('post')}, 0D)"))


def _as_baselines(tails: DataFrame, mean: Column, std: Column, resumable: bool = True) -> DataFrame:
    """Baseline rows; without ``resumable`` the exact fold state is not kept."""
    unknown = F.lit(None).cast("double")
    return tails.select(
        *KEYS,
        mean.alias("mean"),
        std.alias("std"),
        F.col("post.n").alias("n"),
        (F.col("post.c") if resumable else unknown).alias("c"),
        (F.col("post.q") if resumable else unknown).alias("q"),
        F.col("point.minute").alias("last_minute"),
        F.current_timestamp().alias("last_updated"),
        F.lit(None).cast("string").alias("run_id"),
    )


def fresh_enough(baselines: DataFrame, as_of: dt.datetime, max_age_days: int) -> DataFrame:
    """Baselines updated within ``max_age_days``; older series are trained anew."""
    moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc)
    oldest = F.lit((moment - dt.timedelta(days=max_age_days)).isoformat()).cast("timestamp")
    return baselines.where(F.col("last_updated") >= oldest)


def load_or_train(points: DataFrame, stored: DataFrame, params: DetectionParams) -> DataFrame:
    """The saved (mean, std) of each series in ``points``, else a trained one."""
    trained = train_baselines(points, params).select(*KEYS, F.col("mean").alias("t_mean"), F.col("std").alias("t_std"))
    saved = stored.select(*KEYS, F.struct("mean", "std").alias("saved"))
    return trained.join(saved, KEYS, "left").select(
        *KEYS,
        F.coalesce("saved.mean", "t_mean").alias("mean"),
        F.coalesce("saved.std", "t_std").alias("std"),
        F.col("saved").isNull().alias("trained"),
    )


def with_stored(points: DataFrame, baselines: DataFrame, alpha: float) -> DataFrame:
    """Attach saved baselines and drop points a previous run already folded.

    ``baselines`` may hold several runs; the newest row of a series counts.
    """
    state = F.expr(S.stored_state(alpha)).alias("state")
    saved = (
        newest_by_series(baselines)
        .select("series", "b.*")
        .select("series", F.struct(state, "mean", "std", "last_minute").alias("stored"))
    )
    joined = by_series(points).join(saved, "series", "left")
    seen = F.col("stored.last_minute").isNotNull() & (F.col("minute") <= F.col("stored.last_minute"))
    return joined.where(~seen)


def updated_mean(mean: Column, x: Column, alpha: float) -> Column:
    return F.lit(1.0 - alpha) * mean + F.lit(alpha) * x


def updated_std(std: Column, x: Column, new_mean: Column, alpha: float) -> Column:
    variance = F.lit(1.0 - alpha) * std * std + F.lit(alpha) * (x - new_mean) * (x - new_mean)
    return F.greatest(F.sqrt(variance), F.lit(STD_FLOOR))


def _flat(rows: DataFrame, mean: Column, std: Column, score: Column) -> DataFrame:
    return rows.select(
        *KEYS,
        F.col("point.minute").alias("minute"),
        F.col("point.value").alias("value"),
        score.alias("score"),
        mean.alias("baseline_mean"),
        std.alias("baseline_std"),
        # A finding stands for all groups of its minute; tagging fills these in.
        F.lit(None).cast("string").alias("country"),
        F.lit(None).cast("string").alias("ua"),
        F.col("point.source_type").alias("source_type"),
    )


def _score_prior(rows: DataFrame, params: DetectionParams) -> DataFrame:
    std = F.expr(S.state_std("prior"))
    enough = F.col("prior.n") >= params.min_count
    x, mean = F.col("point.value"), F.col("prior.mean")
    spread = F.when((std == 0) & (x != mean), F.lit(STD_FLOOR)).otherwise(std) if params.flag_flat else std
    score = F.when(enough, S.zscore(x, mean, spread))
    return _flat(rows, F.col("prior.mean"), std, score)


def _post_update_columns(tails: DataFrame, alpha: float) -> DataFrame:
    mean, std = F.col("post.mean"), F.expr(f"coalesce({S.state_std('post')}, 0D)")
    if "stored" in tails.columns:
        mean, std = F.coalesce("stored.mean", mean), F.coalesce("stored.std", std)
    x = F.col("point.value")
    return (
        tails.withColumns({"b_mean": mean, "b_std": std})
        .withColumn("u_mean", updated_mean(F.col("b_mean"), x, alpha))
        .withColumn("u_std", updated_std(F.col("b_std"), x, F.col("u_mean"), alpha))
    )


def top_findings(scored: DataFrame, sigma: float, top_k: int | None) -> DataFrame:
    """Scores beyond ``sigma`` (strictly), strongest first, with their direction."""
    beyond = scored.where(F.abs("score") > sigma).withColumn(
        "mode", F.when(F.col("score") > 0, "high").otherwise("low")
    )
    if top_k is None:
        return beyond
    return beyond.orderBy(F.abs("score").desc(), *KEYS, "minute").limit(top_k)


def score_points(points: DataFrame, params: DetectionParams, baselines: DataFrame | None = None) -> DataFrame:
    """Every scored point, anomalous or not, in ``prior`` mode with ``scope="all"``."""
    ready = to_points(points)
    if baselines is not None:
        ready = with_stored(ready, baselines, params.alpha)
    rows = point_states(ready, params.alpha, params.block_minutes, silent_step=params.silent_step)
    return _score_prior(rows, params)


def detect_anomalies(
    points: DataFrame,
    params: DetectionParams,
    baselines: DataFrame | None = None,
    top_k: int | None = -1,
    keep: Callable[[DataFrame, str], DataFrame] | None = None,
    until: dt.datetime | None = None,
) -> Detection:
    """Findings, strongest first, and the new baseline of every series seen.

    ``top_k`` defaults to the parameter's; None keeps all findings. Both results
    fold the points anew when they are used, unless ``keep`` (a table and a name
    to the table to go on with) writes the fold down for both.

    With ``silence="zero"``, ``until`` is the newest step that is over: series of
    ``points`` or ``baselines`` without a point there are scored on a 0.
    """
    limit = params.top_k if top_k == -1 else top_k
    ready = to_points(points)
    if until is not None and params.silence == "zero":
        moment = until if until.tzinfo else until.replace(tzinfo=dt.timezone.utc)
        ready = with_silence(ready, F.lit(moment.isoformat()).cast("timestamp"), baselines)
    if baselines is not None:
        ready = with_stored(ready, baselines, params.alpha)
    if keep is not None and params.scope == "all":
        rows = keep(point_states(ready, params.alpha, params.block_minutes, silent_step=params.silent_step), "states")
        newest = F.max_by(F.struct("point", "post"), "point.minute").alias("newest")
        tails = rows.groupBy(*KEYS).agg(newest).select(*KEYS, "newest.*")
    else:
        tails = series_tails(ready, params.alpha, params.block_minutes, silent_step=params.silent_step)
        tails = tails if keep is None else keep(tails, "tails")
        rows = tails
        if params.scope == "all":
            rows = point_states(ready, params.alpha, params.block_minutes, silent_step=params.silent_step)
    if params.mode == "post_update":
        updated = _post_update_columns(tails, params.alpha)
        mean, std = F.col("u_mean"), F.col("u_std")
        scored = _flat(updated, mean, std, (F.col("point.value") - mean) / std)
        return Detection(top_findings(scored, params.sigma, limit), _as_baselines(updated, mean, std, resumable=False))
    scored = _score_prior(rows, params)
    fresh = _as_baselines(tails, F.col("post.mean"), F.expr(f"coalesce({S.state_std('post')}, 0D)"))
    return Detection(top_findings(scored, params.sigma, limit), fresh)


def run_summary(findings: DataFrame) -> DataFrame:
    """Number of findings and the largest absolute score (0 if there is none)."""
    return findings.agg(
        F.count(F.lit(1)).alias("anomaly_count"),
        F.coalesce(F.max(F.abs("score")), F.lit(0.0)).alias("max_anomaly_score"),
    )
