"""One address holds a third of all rows; results are compared with plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surgelens.operators import hotspots, indicators
from surgelens.operators.scoring import detect_anomalies
from surgelens.params import DetectionParams
from surgelens.sources.baselines import BaselineStore, newest_per_series
from surgelens.sources.indicators import Indicators

START = 1706616000
AS_OF = dt.datetime.fromtimestamp(START + 3600, dt.timezone.utc)


@pytest.fixture(scope="module")
def requests():
    rng = random.Random(29)
    rows = []
    for i in range(6000):
        hot = i % 3 == 0
        second = START + (rng.randrange(60) + 40 * 60 if hot and rng.random() < 0.5 else rng.randrange(3600))
        ip = "10.0.0.77" if hot else f"10.0.{rng.randrange(4)}.{rng.randrange(8)}"
        rows.append((second, ip, "/kelp/dock" if hot else rng.choice(["/", "/a", "/b"])))
    return rows


@pytest.fixture()
def logs(spark, requests):
    flat = spark.createDataFrame(requests, "s bigint, ip string, uri string").repartition(7)
    return flat.select(
        (F.col("s") * 1000).alias("timestamp"),
        F.struct(
            F.col("ip").alias("clientIp"), F.col("uri").alias("uri"), F.lit("US").alias("country"),
            F.array(F.struct(F.lit("User-Agent").alias("name"), F.lit("ua").alias("value"))).alias("headers"),
        ).alias("httpRequest"),
        F.array().cast("array<struct<name:string>>").alias("labels"),
    )


def counted(requests):
    return Counter((s // 60 * 60, ip, uri) for s, ip, uri in requests)


def test_counts(logs, requests):
    got = hotspots.waf_counts(logs, AS_OF, 60).select(F.unix_seconds("minute").alias("m"), "key", "subkey", "value").collect()
    assert {(r["m"], r["key"], r["subkey"]): r["value"] for r in got} == counted(requests)
    assert sum(r["value"] for r in got) == len(requests)
    top = hotspots.waf_hotspots(logs, AS_OF, 60, 5).collect()
    assert [r["value"] for r in top] == sorted(counted(requests).values(), reverse=True)[:5]


def brute_force(requests, alpha, min_count, sigma):
    series = {}
    for (m, ip, uri), n in sorted(counted(requests).items()):
        series.setdefault((ip, uri), []).append((m, n))
    found = {}
    for key, points in series.items():
        mean, c, q, n = float(points[0][1]), 0.0, 1.0, 1
        for m, x in points[1:]:
            if n >= max(min_count, 2):
                std = (c / (1 - q)) ** 0.5
                score = (x - mean) / std if std else 0.0
                if abs(score) > sigma:
                    found[(key, m)] = score
            d = x - mean
            mean, c, q = mean + alpha * d, (1 - alpha) * (c + alpha * d * d), (1 - alpha) ** 2 * q + alpha * alpha
            n += 1
    return found


@pytest.mark.parametrize("block_points", [10_080, 9])
def test_findings(logs, requests, block_points):
    params = DetectionParams(scope="all", sigma=2.0, min_count=5, lookback_minutes=60, block_points=block_points)
    counts = hotspots.waf_counts(logs, AS_OF, 60, with_ua=True)
    found = detect_anomalies(counts, params, top_k=None).findings
    got = {((r["key"], r["subkey"]), r["m"]): r["score"] for r in found.withColumn("m", F.unix_seconds("minute")).collect()}
    want = brute_force(requests, 0.3, 5, 2.0)
    assert (("10.0.0.77", "/kelp/dock"), START + 2400) in want
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_matching_keeps_every_row(logs, requests):
    flat = logs.select(F.col("httpRequest.clientIp").alias("ip"))
    networks = [f"10.{i}.0.0/16" for i in range(1, 120)] + ["10.0.0.77/32", "10.0.2.0/24"]
    got = indicators.match_cidr(flat, "ip", Indicators.from_config({"cidrs": networks})).groupBy("cidr_rule").count()
    want = Counter(
        "CIDR:10.0.0.77/32" if ip == "10.0.0.77" else "CIDR:10.0.2.0/24" if ip.startswith("10.0.2.") else None
        for _, ip, _ in requests
    )
    assert {r["cidr_rule"]: r["count"] for r in got.collect()} == want


def test_newest_baseline_of_a_busy_series(spark, fresh):
    store = BaselineStore(spark, fresh("busy"))
    for run in range(4):
        rows = spark.range(3).select(
            F.lit("m").alias("metric"), F.col("id").cast("string").alias("key"), F.lit("s").alias("subkey"),
            F.lit(float(run)).alias("mean"), F.lit(1.0).alias("std"), F.lit(1).cast("bigint").alias("n"),
            F.lit(0.0).alias("c"), F.lit(0.0).alias("q"), F.current_timestamp().alias("last_minute"),
            F.current_timestamp().alias("last_updated"),
        )
        store.append(rows.where(F.col("id") <= (0 if run else 2)), f"{run}")
    assert store.history().count() == 6
    assert {r["key"]: r["mean"] for r in newest_per_series(store.history()).collect()} == {"0": 3.0, "1": 0.0, "2": 0.0}
