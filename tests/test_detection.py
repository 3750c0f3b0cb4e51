import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from surgelens.operators import hotspots, series
from surgelens.operators.scoring import (
    detect_anomalies,
    fresh_enough,
    load_or_train,
    run_summary,
    score_points,
    top_findings,
    train_baselines,
)
from surgelens.operators.series import to_points
from surgelens.params import DetectionParams

POINT = "minute string, key string, subkey string, value double, metric string"
BASE = DetectionParams(alpha=0.3, sigma=3.0, top_k=5, min_count=2)


def frame(spark, values, key="1.1.1.1", subkey="/a", metric="request_count"):
    return spark.createDataFrame(
        [(f"2023-10-26T10:{i:02d}", key, subkey, float(v), metric) for i, v in enumerate(values)], POINT
    )


def burst():
    rng = random.Random(3)
    return [rng.gauss(100, 5) if i == 7 else rng.gauss(10, 1) for i in range(10)]


def test_burst_in_the_middle_needs_every_point(spark):
    df = frame(spark, burst())
    found = detect_anomalies(df, BASE.with_(scope="all")).findings.collect()
    assert f"{found[0]['minute']:%H:%M}" == "10:07" and found[0]["mode"] == "high"
    assert all(f"{f['minute']:%H:%M}" != "10:09" for f in found)
    assert detect_anomalies(df, BASE).findings.count() == 0


def test_calm_series(spark):
    rng = random.Random(1)
    df = frame(spark, [10 + 0.5 * rng.uniform(-1, 1) for _ in range(10)])
    assert detect_anomalies(df, BASE.with_(scope="all", min_count=4)).findings.count() == 0


def test_cold_start(spark):
    df = frame(spark, [50, 55, 150])
    found = detect_anomalies(df, BASE).findings.collect()
    assert len(found) == 1 and found[0]["score"] == pytest.approx(27.8600, abs=1e-3)
    late = detect_anomalies(df, BASE.with_(mode="post_update", sigma=0.0)).findings.collect()
    assert late[0]["score"] == pytest.approx(0.8838, abs=1e-4)
    assert detect_anomalies(df, BASE.with_(mode="post_update")).findings.count() == 0


def test_two_metrics(spark):
    df = frame(spark, [10, 12, 100]).unionByName(frame(spark, [5, 6, 50], metric="connection_count"))
    found = detect_anomalies(df, BASE).findings.collect()
    assert {f["metric"] for f in found} == {"request_count", "connection_count"}
    assert abs(found[0]["score"]) >= abs(found[1]["score"])
    by_metric = {f["metric"]: f["score"] for f in found}
    assert by_metric["request_count"] == pytest.approx(63.2, abs=0.1)


def test_min_count_and_single_points(spark):
    assert detect_anomalies(frame(spark, [10, 12, 100]), BASE.with_(min_count=3)).findings.count() == 0
    one = detect_anomalies(frame(spark, [42]), BASE.with_(sigma=0.0))
    assert one.findings.count() == 0
    saved = one.baselines.first()
    assert (saved["mean"], saved["std"], saved["n"]) == (42.0, 0.0, 1)


def test_constant_series_scores_zero(spark):
    df = frame(spark, [7, 7, 7, 7])
    assert detect_anomalies(df, BASE.with_(sigma=0.0)).findings.count() == 0
    updated = detect_anomalies(df, BASE.with_(mode="post_update", sigma=0.0)).baselines.first()
    assert (updated["mean"], updated["std"]) == (pytest.approx(7.0), 1e-6)


def test_post_update_is_bounded(spark):
    rng = random.Random(5)
    df = None
    for k in range(40):
        values = [rng.expovariate(0.01) for _ in range(rng.randint(1, 12))]
        values[-1] *= rng.choice([1, 10, 1000])
        part = frame(spark, values, key=str(k))
        df = part if df is None else df.unionByName(part)
    found = detect_anomalies(df, BASE.with_(mode="post_update", sigma=0.0), top_k=None).findings
    worst = found.agg(F.max(F.abs("score"))).first()[0]
    assert worst < 1 / math.sqrt(0.3)
    assert run_summary(found).first()["max_anomaly_score"] == worst


def test_post_update_by_hand(spark):
    got = detect_anomalies(frame(spark, [10, 12, 11, 13, 15]), BASE.with_(mode="post_update", sigma=0.0)).findings.first()
    mean = 0.7 * 12.4828 + 0.3 * 15
    std = math.sqrt(0.7 * 2.208243**2 + 0.3 * (15 - mean) ** 2)
    assert got["baseline_mean"] == pytest.approx(mean, abs=1e-6)
    assert got["baseline_std"] == pytest.approx(std, abs=1e-5)
    assert got["score"] == pytest.approx((15 - mean) / std, abs=1e-5)


def test_missing_keys_and_text_values(spark):
    rows = [
        ("2023-10-26T10:00", None, None, "3", "m"),
        ("2023-10-26T10:01", None, None, "null", "m"),
        ("2023-10-26T10:02", "k", None, " 4.5", "m"),
        ("2023-10-26T10:03", "k", None, "1d", "m"),
    ]
    df = spark.createDataFrame(rows, "minute string, key string, subkey string, value string, metric string")
    got = to_points(df).orderBy("minute").collect()
    assert [r["value"] for r in got] == [3.0, 0.0, 4.5, 0.0]
    assert {r["subkey"] for r in got} == {"N/A"} and got[0]["key"] == "N/A"
    without = to_points(df.drop("subkey"))
    assert without.select("subkey").distinct().collect()[0][0] == "N/A"
    assert train_baselines(df, BASE).count() == 2


def test_empty_input(spark):
    df = frame(spark, [])
    found = detect_anomalies(df, BASE)
    assert found.findings.count() == 0 and found.baselines.count() == 0
    summary = run_summary(found.findings).first()
    assert (summary["anomaly_count"], summary["max_anomaly_score"]) == (0, 0.0)


@pytest.mark.parametrize("lookback,block", [(15, 10_080), (100_000, 10_080), (100_000, 3)])
def test_resuming_equals_one_fold(spark, lookback, block):
    params = BASE.with_(scope="all", sigma=0.5, lookback_minutes=lookback, block_points=block)
    rng = random.Random(9)
    df = frame(spark, [rng.randint(1, 30) for _ in range(20)])
    early = df.where(F.substring("minute", 15, 2).cast("int") < 11)
    whole = {r["minute"]: r["score"] for r in detect_anomalies(df, params, top_k=None).findings.collect()}
    stored = detect_anomalies(early, params).baselines
    resumed = detect_anomalies(df, params, stored, top_k=None)
    again = {r["minute"]: r["score"] for r in resumed.findings.collect()}
    assert again and min(again) > dt.datetime(2023, 10, 26, 10, 10)
    assert again == {m: pytest.approx(s) for m, s in whole.items() if m in again}
    assert set(again) == {m for m in whole if m > dt.datetime(2023, 10, 26, 10, 10)}
    end, want = resumed.baselines.first(), detect_anomalies(df, params).baselines.first()
    assert (end["mean"], end["std"], end["n"]) == pytest.approx((want["mean"], want["std"], want["n"]))


def test_points_already_folded_are_skipped(spark):
    df = frame(spark, [10, 12, 100])
    stored = detect_anomalies(df, BASE).baselines
    again = detect_anomalies(df, BASE, stored)
    assert again.findings.count() == 0 and again.baselines.count() == 0


def test_bare_stored_baseline(spark):
    stored = spark.createDataFrame(
        [("request_count", "1.1.1.1", "/a", 10.0, 2.0)], "metric string, key string, subkey string, mean double, std double"
    )
    got = detect_anomalies(frame(spark, [17]), BASE, stored).findings.first()
    assert got["score"] == pytest.approx(3.5)
    post = detect_anomalies(frame(spark, [17]), BASE.with_(mode="post_update", sigma=0.0), stored).findings.first()
    assert post["baseline_mean"] == pytest.approx(12.1)
    both = load_or_train(frame(spark, [17]), stored, BASE).first()
    assert (both["mean"], both["std"], both["trained"]) == (10.0, 2.0, False)


def test_training_window_and_age(spark):
    df = spark.createDataFrame(
        [("2023-10-01T00:00", "k", "s", 99.0, "m"), ("2023-10-25T00:00", "k", "s", 5.0, "m")], POINT
    )
    as_of = dt.datetime(2023, 10, 26, tzinfo=dt.timezone.utc)
    trained = train_baselines(df, BASE, as_of).first()
    assert (trained["mean"], trained["n"]) == (5.0, 1)
    old = train_baselines(df, BASE).withColumn("last_updated", F.lit("2023-10-01 00:00:00").cast("timestamp"))
    assert fresh_enough(old, as_of, 7).count() == 0 and fresh_enough(old, as_of, 60).count() == 1


def test_strict_threshold_order_and_limit(spark):
    scored = spark.createDataFrame(
        [("m", "a", "s", 0, 3.0), ("m", "b", "s", 0, -5.0), ("m", "c", "s", 0, 4.0), ("m", "d", "s", 0, 4.0)],
        "metric string, key string, subkey string, minute int, score double",
    )
    got = top_findings(scored, 3.0, 2).collect()
    assert [(r["key"], r["mode"]) for r in got] == [("b", "low"), ("c", "high")]
    assert top_findings(scored, 3.0, None).count() == 3


def test_every_scored_point_is_kept(spark):
    rows = score_points(frame(spark, [1, 2, 3, 4]), BASE).orderBy("minute").collect()
    assert [r["score"] is None for r in rows] == [True, True, False, False]


def test_a_burst_in_one_of_a_minutes_groups_is_found(spark):
    rows = [(f"2023-10-26T10:{i:02d}", "k", "s", 10.0 + i % 2, "request_count", "US") for i in range(10)]
    rows += [("2023-10-26T10:10", "k", "s", n, "request_count", c) for n, c in ((1000.0, "KP"), (10.0, "US"))]
    df = spark.createDataFrame(rows, POINT + ", country string")
    found = detect_anomalies(df, DetectionParams()).findings.collect()
    assert [(f["value"], f["mode"]) for f in found] == [(1010.0, "high")]
    saved = detect_anomalies(df, DetectionParams()).baselines.first()
    assert saved["n"] == 11


def test_a_block_is_bounded_whatever_the_declared_lookback(spark):
    minutes = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).alias("minute")
    keys = [F.lit(x).alias(n) for n, x in (("metric", "m"), ("key", "k"), ("subkey", "s"))]
    df = spark.range(3000).select(*keys, minutes, F.lit(1.0).alias("value"))
    blocks = series.to_blocks(series.by_series(to_points(df.unionAll(df))), 0.3, 500)
    assert blocks.agg(F.max(F.size("points"))).first()[0] <= 500
    assert detect_anomalies(df.unionAll(df), DetectionParams(block_points=500)).baselines.first()["n"] == 3000


def test_open_minute(spark):
    df = spark.createDataFrame([("2023-10-26 10:00:00", 1), ("2023-10-26 10:01:00", 1)], "m string, value int")
    df = df.withColumn("minute", F.col("m").cast("timestamp"))
    assert hotspots.drop_open_minute(df, dt.datetime(2023, 10, 26, 10, 1, 30)).count() == 1


@pytest.mark.parametrize("bad", [{"alpha": 0.0}, {"alpha": 1.5}, {"sigma": -1.0}, {"mode": "x"}, {"scope": "x"}, {"top_k": 0}, {"mode": "post_update", "scope": "all"}])
def test_bad_parameters(bad):
    with pytest.raises(ValueError):
        DetectionParams(**bad)


def test_saved_counts_are_opened_for_missing_series_only(spark, fresh, monkeypatch):
    from surgelens.plans import detection
    from surgelens.sources.baselines import BaselineStore, keyed_rows

    as_of = dt.datetime(2023, 10, 26, 11, 0)
    params = BASE.with_(max_age_days=1)
    rows = frame(spark, [10, 12, 11], key="a").union(frame(spark, [20, 22, 21], key="b"))
    root = fresh("history")
    rows.write.parquet(root + "/run_id=20231026T103000")
    store = BaselineStore(spark, root + "-store")
    store.append(train_baselines(rows, params), "r1")
    counts = to_points(rows)
    asked = []
    original = detection.saved_counts
    monkeypatch.setattr(detection, "saved_counts", lambda *a: asked.append(a) or original(*a))
    recent = keyed_rows(store.history()).withColumn("last_updated", F.lit(as_of.isoformat()).cast("timestamp"))
    assert detection.refreshed(recent, counts, root, as_of, params).count() == 2 and not asked
    some = recent.where("series.key = 'a'")
    got = detection.refreshed(some, counts, root, as_of, params).select("series.key", "run_id", "mean").collect()
    assert sorted((r["key"], r["run_id"]) for r in got) == [("a", "r1"), ("b", None)] and len(asked) == 1
    want = {r["key"]: r["mean"] for r in train_baselines(rows, params).collect()}
    assert next(r["mean"] for r in got if r["key"] == "b") == pytest.approx(want["b"])
    nothing = detection.refreshed(some, counts, root + "-none", as_of, params)
    assert nothing.count() == 1


def sparse(seed=5):
    rng = random.Random(seed)
    return {m: float(rng.randint(5, 15)) for m in range(60) if rng.random() < 0.6 and not 30 <= m < 45}


def at(values, key="1.1.1.1"):
    return [(f"2023-10-26T10:{m:02d}", key, "/a", v, "request_count") for m, v in values.items()]


@pytest.mark.parametrize("block", [4, 10_080])
def test_silent_minutes_count_as_zero(spark, block):
    values = sparse()
    dense = {m: values.get(m, 0.0) for m in range(min(values), max(values) + 1)}
    params = BASE.with_(scope="all", block_points=block)
    gapped = score_points(spark.createDataFrame(at(values), POINT), params.with_(silence="zero")).orderBy("minute").collect()
    full = score_points(spark.createDataFrame(at(dense), POINT), params).where("value > 0").orderBy("minute").collect()
    assert [g["minute"] for g in gapped] == [f["minute"] for f in full]
    for g, f in zip(gapped, full):
        for name in ("score", "baseline_mean", "baseline_std"):
            assert g[name] == (None if f[name] is None else pytest.approx(f[name], abs=1e-9))
    a = detect_anomalies(spark.createDataFrame(at(values), POINT), params.with_(silence="zero", scope="last")).baselines.first()
    b = detect_anomalies(spark.createDataFrame(at(dense), POINT), params.with_(scope="last")).baselines.first()
    assert all(a[n] == pytest.approx(b[n]) for n in ("mean", "std", "n", "c", "q"))


def test_silence_carries_over_runs(spark):
    values = sparse(6)
    early, late = {m: v for m, v in values.items() if m < 28}, {m: v for m, v in values.items() if m >= 28}
    params = BASE.with_(silence="zero", scope="all")
    saved = detect_anomalies(spark.createDataFrame(at(early), POINT), params).baselines
    got = score_points(spark.createDataFrame(at(late), POINT), params, saved).orderBy("minute").collect()
    want = score_points(spark.createDataFrame(at(values), POINT), params).where("minute >= '2023-10-26 10:28:00'").orderBy("minute").collect()
    assert [g["score"] for g in got] == [pytest.approx(w["score"]) for w in want]


def test_a_silent_series_is_found_low(spark):
    busy = {m: 100.0 + m % 2 for m in range(20)}
    rows = at({**busy, **{m: 100.0 for m in range(20, 30)}}, "on") + at(busy, "off")
    params = BASE.with_(silence="zero", scope="last", sigma=3.0)
    until = dt.datetime(2023, 10, 26, 10, 20)
    df = spark.createDataFrame([r for r in rows if r[0] <= "2023-10-26T10:20"], POINT)
    found = detect_anomalies(df, params, until=until).findings.collect()
    assert [(f["key"], f["value"], f["mode"]) for f in found] == [("off", 0.0, "low")]
    # Known from a baseline alone, without any point in the run.
    saved = detect_anomalies(spark.createDataFrame(at(busy, "off"), POINT), params).baselines
    alone = spark.createDataFrame(at({20: 100.0}, "on"), POINT)
    found = detect_anomalies(alone, params, saved, until=until)
    assert [(f["key"], f["mode"]) for f in found.findings.collect()] == [("off", "low")]
    assert {r["key"] for r in found.baselines.collect()} == {"on", "off"}
    assert detect_anomalies(df, params.with_(silence="skip"), until=until).findings.count() == 0


def test_any_deviation_from_a_flat_series(spark):
    df = frame(spark, [5, 5, 5, 5, 5.001, 5])
    assert detect_anomalies(df, BASE.with_(scope="all")).findings.count() == 0
    found = detect_anomalies(df, BASE.with_(scope="all", flag_flat=True)).findings.collect()
    assert [f["value"] for f in found] == [5.001] and found[0]["mode"] == "high" and found[0]["baseline_std"] == 0
