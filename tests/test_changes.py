import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from surgelens.functions import cumulative as C
from surgelens.operators.changes import ChangeParams, change_alarms, change_states, cumulative_sums
from surgelens.sources.baselines import KEYS
from test_plans import plan, shuffles

START = dt.datetime(2024, 1, 1)
SCHEMA = "metric string, key string, subkey string, minute timestamp, value double"
PARAMS = ChangeParams(drift=0.25, limit=2.0, block_minutes=7)


def walk(values, params, mean, std, up=0.0, down=0.0):
    out = []
    for v in values:
        z = (v - mean) / std if std else 0.0
        u, d = up + z - params.drift, down - z - params.drift
        alarm = "both" if min(u, d) > params.limit else "up" if u > params.limit else "down" if d > params.limit else None
        up, down = (0.0 if x > params.limit else max(0.0, x) for x in (u, d))
        out.append((v, up, down, alarm, max(u, d) if alarm else None))
    return out


@pytest.fixture(scope="module")
def steps(spark):
    rnd = random.Random(4)
    rows = [("m", f"k{k}", "s", START + dt.timedelta(minutes=i), rnd.gauss(10, 1) + (k % 3) * (i > 60)) for k in range(5) for i in range(120) if rnd.random() < 0.9]
    rows += [("m", "flat", "s", START + dt.timedelta(minutes=i), 3.0) for i in range(9)] + [("m", "one", "s", START, 1.0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


def series_of(df):
    found = {}
    for r in df.orderBy("minute").collect():
        found.setdefault(r["key"], []).append(r)
    return found


@pytest.mark.parametrize("block_minutes", [1, 7, 10_000])
def test_sums_match_a_walk(steps, block_minutes):
    params = ChangeParams(0.25, 2.0, block_minutes)
    given, got = series_of(steps), series_of(cumulative_sums(steps, params))
    assert given.keys() == got.keys()
    alarms = set()
    for key, rows in given.items():
        values = [r["value"] for r in rows]
        std = statistics.stdev(values) if len(values) > 1 else None
        want = walk(values, params, statistics.fmean(values), std)
        for w, g in zip(want, got[key], strict=True):
            assert (g["value"], g["alarm"]) == (w[0], w[3])
            assert (g["up"], g["down"]) == (pytest.approx(w[1], abs=1e-9), pytest.approx(w[2], abs=1e-9))
            assert g["reached"] == (None if w[4] is None else pytest.approx(w[4]))
            alarms.add(g["alarm"])
    assert {"up", "down", None} <= alarms


def test_summaries_apply_to_any_start(spark):
    rnd, limit = random.Random(5), 2.0
    rows = [([rnd.gauss(0, 1) for _ in range(rnd.randint(0, 12))], rnd.uniform(0, limit)) for _ in range(400)]
    df = spark.createDataFrame(rows, "steps array<double>, s double").withColumn("u", F.expr(C.summary("steps", limit)))
    for r in df.withColumn("after", F.expr(C.applied("s", "u"))).collect():
        s = r["s"]
        for d in r["steps"]:
            s = 0.0 if s + d > limit else max(0.0, s + d)
        assert r["after"] == pytest.approx(s, abs=1e-9)


def test_a_resumed_run_equals_one_fold(steps):
    targets = steps.groupBy(*KEYS).agg(F.lit(10.0).alias("mean"), F.lit(1.0).alias("std"))
    whole = cumulative_sums(steps, PARAMS, targets)
    cut = START + dt.timedelta(minutes=50)
    first = cumulative_sums(steps.where(F.col("minute") < F.lit(cut)), PARAMS, targets)
    # The second run is given some minutes again; they are not folded twice.
    again = steps.where(F.col("minute") >= F.lit(cut - dt.timedelta(minutes=9)))
    second = cumulative_sums(again, PARAMS, targets, change_states(first))
    rows = lambda df: sorted((r["key"], r["minute"], round(r["up"], 9), round(r["down"], 9), r["alarm"] or "") for r in df.collect())
    assert rows(first.unionByName(second)) == rows(whole)
    assert change_states(whole).where("key = 'flat'").first()["last_minute"] == START + dt.timedelta(minutes=8)


def test_targets_decide(spark, steps):
    none = steps.select(*KEYS).distinct().withColumns({"mean": F.lit(0.0), "std": F.lit(0.0)})
    assert change_alarms(steps, PARAMS, none).count() == 0
    few = none.where("key = 'k1'").withColumn("std", F.lit(1.0))
    assert {r["key"] for r in change_alarms(steps, PARAMS, few).collect()} == {"k1"}
    assert cumulative_sums(steps.where("false"), PARAMS).count() == 0
    assert math.isclose(cumulative_sums(steps.withColumn("value", F.lit(None).cast("double")), PARAMS).agg(F.max("value")).first()[0], 0.0)


def test_one_shuffle(spark, fresh):
    path = fresh("points")
    spark.range(50).selectExpr("'m' AS metric", "'k' || id % 3 AS key", "'s' AS subkey", "timestamp_seconds(id * 60) AS minute", "1.0D * id AS value").write.parquet(path)
    df = change_alarms(spark.read.parquet(path), PARAMS)
    assert shuffles(df) == 1 and "Python" not in plan(df) and "SinglePartition" not in plan(df)


def test_bad_params():
    for bad in ({"drift": -1.0}, {"limit": 0.0}, {"block_minutes": 0}):
        with pytest.raises(ValueError):
            ChangeParams(**bad)
