import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from surgelens.functions import smoothing as S
from surgelens.operators import series

GOLDEN_MEAN = [10, 10.6, 10.72, 11.404, 12.4828]
GOLDEN_STD = [None, 1.414214, 0.996639, 1.449535, 2.208243]


def points_frame(spark, data):
    """``data``: (key, minute number, value)."""
    rows = [("m", k, "s", i * 60, float(v)) for k, i, v in data]
    df = spark.createDataFrame(rows, "metric string, key string, subkey string, at bigint, value double")
    return series.to_points(df.withColumn("minute", F.timestamp_seconds(F.col("at") + 1_700_000_000 // 60 * 60)))


def smoothed(df, alpha, block):
    rows = series.smoothed(df, alpha, block).orderBy("key", "minute").collect()
    out = {}
    for r in rows:
        out.setdefault(r["key"], []).append((r["ewma"], r["ewma_std"]))
    return out


@pytest.mark.parametrize("block", [10_080, 2, 1])
def test_golden_series(spark, block):
    df = points_frame(spark, [("k", i, v) for i, v in enumerate([10, 12, 11, 13, 15])])
    got = smoothed(df, 0.3, block)["k"]
    assert [g[0] for g in got] == pytest.approx(GOLDEN_MEAN)
    assert got[0][1] is None
    assert [g[1] for g in got[1:]] == pytest.approx(GOLDEN_STD[1:], abs=1e-6)


@pytest.mark.parametrize("alpha", [0.05, 0.3, 0.9])
@pytest.mark.parametrize("block", [10_080, 37, 500])
def test_equals_pandas(spark, alpha, block):
    rng = random.Random(7)
    data = {k: [rng.gauss(1000, 3) if k == "b" else rng.expovariate(0.1) for _ in range(n)] for k, n in (("a", 200), ("b", 131), ("c", 1))}
    df = points_frame(spark, [(k, i * (3 if k == "b" else 1), v) for k, vs in data.items() for i, v in enumerate(vs)])
    got = smoothed(df, alpha, block)
    for k, values in data.items():
        window = pd.Series(values).ewm(alpha=alpha, adjust=False)
        mean, std = window.mean(), window.std()
        assert [g[0] for g in got[k]] == pytest.approx(list(mean), rel=1e-10)
        for have, want in zip((g[1] for g in got[k]), std):
            assert (have is None and math.isnan(want)) or have == pytest.approx(want, rel=1e-8)


@pytest.mark.parametrize("block", [10_080, 13, 64])
def test_tails_agree_with_full_path(spark, block):
    rng = random.Random(11)
    df = points_frame(spark, [(k, i, rng.randint(0, 50)) for k in "xyz" for i in range(130 if k == "x" else 3)])
    path = series.point_states(df, 0.3, 10_080)
    newest = {}
    for r in path.orderBy("key", "point.minute").collect():
        newest[r["key"]] = r
    for r in series.series_tails(df, 0.3, block).collect():
        want = newest[r["key"]]
        assert r["point"]["value"] == want["point"]["value"]
        for state in ("prior", "post"):
            assert tuple(r[state]) == pytest.approx(tuple(want[state]), rel=1e-9)


def test_zscore(spark):
    df = spark.createDataFrame([(10.0,), (15.0,), (20.0,)], "x double")
    got = df.select(S.zscore(F.col("x"), F.lit(15.0), F.lit(2.0)), S.zscore(F.col("x"), F.lit(10.0), F.lit(0.0))).collect()
    assert [r[0] for r in got] == [-2.5, 0.0, 2.5]
    assert [r[1] for r in got] == [0.0, 0.0, 0.0]


def test_smoothing_of_weight_one(spark):
    df = points_frame(spark, [("k", i, v) for i, v in enumerate([1, 5, 3])])
    assert smoothed(df, 1.0, 2)["k"] == [(1.0, None), (5.0, None), (3.0, None)]


def test_a_minute_is_the_sum_of_its_groups(spark):
    df = points_frame(spark, [("k", 0, 1), ("k", 1, 2), ("k", 1, 8), ("k", 1, 4)])
    rows = series.point_states(df, 0.3, 10_080).select("point.value", "prior.n").orderBy("n").collect()
    assert [r[0] for r in rows] == [1.0, 14.0]
    tail = series.series_tails(df, 0.3, 10_080).first()
    latest = series.latest_point(df).first()
    assert tail["point"]["value"] == latest["value"] == 14.0
