"""What the physical plans must look like to hold at a thousand times the data."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from surgelens.operators import hotspots, indicators, series, slices, windows
from surgelens.operators.scoring import detect_anomalies
from surgelens.params import DetectionParams
from surgelens.plans.detection import detect_and_tag
from surgelens.sources.baselines import BaselineStore, of_active_series
from surgelens.sources.indicators import Indicators

AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
LONG = DetectionParams(lookback_minutes=31 * 24 * 60, scope="all")
NO_GROUPS_ON_ONE_TASK = "SinglePartition"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture()
def events(spark, fresh):
    path = fresh("events")
    rows = spark.range(2000).select(
        F.timestamp_seconds(F.lit(1706659200) - F.col("id") * 60).cast("timestamp_ntz").alias("ts"),
        F.lit("count").alias("metric"),
        F.concat(F.lit("10.0.0."), (F.col("id") % 7).cast("string")).alias("key"),
        F.lit("unused").alias("wide"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def test_time_bounds_and_columns_reach_the_scan(events):
    p = plan(slices.lookback(events, "ts", AS_OF, 60).groupBy("key").count())
    assert "GreaterThanOrEqual(ts" in p and "LessThanOrEqual(ts" in p
    assert "wide" not in p and "metric" not in p


def test_epoch_bounds_reach_the_scan(spark, fresh):
    path = fresh("flows")
    spark.range(10).select(F.col("id").alias("start"), F.lit("a").alias("srcaddr"), F.lit(1).alias("dstport")).write.parquet(path)
    p = plan(hotspots.vpc_counts(spark.read.parquet(path), AS_OF, 15))
    assert "GreaterThanOrEqual(start,1706658300)" in p


def test_counts_combine_before_their_one_shuffle(events):
    df = hotspots.count_groups(events, [F.date_trunc("minute", "ts").alias("minute"), "key"])
    p = plan(df)
    assert shuffles(df) == 1 and p.count("partial_count(1)") == 1
    top = plan(hotspots.top_by_value(df, 5, ["minute", "key"]))
    assert "TakeOrderedAndProject" in top and "rangepartitioning" not in top


def test_agents_are_counted_by_hash_and_without_a_sort(spark, fresh):
    path = fresh("requests")
    one = (1706658300000, ("1.2.3.4", "US", [("User-Agent", "x")], "/", "GET"), [("a",)])
    kind = "struct<clientIp:string,country:string,headers:array<struct<name:string,value:string>>,uri:string,method:string>"
    spark.createDataFrame([one], f"timestamp long, httpRequest {kind}, labels array<struct<name:string>>").write.parquet(path)
    p = plan(hotspots.waf_counts(spark.read.parquet(path), AS_OF, 15, with_ua=True))
    assert "HashAggregate" in p and "SortAggregate" not in p and "Sort [" not in p


def test_views_read_only_their_partitions(spark, fresh):
    path = fresh("dated")
    columns = "start end srcaddr dstaddr srcport dstport protocol packets bytes action log_status".split()
    rows = spark.range(3).select(*[F.col("id").alias(c) for c in columns], F.lit("2024-01-30").alias("dt"), F.lit("23").alias("hr"))
    rows.write.partitionBy("dt", "hr").parquet(path)
    p = plan(slices.slice_vpc(spark.read.schema(rows.schema).parquet(path), AS_OF, 60))
    assert "PartitionFilters: []" not in p and "dt#" in p.split("PartitionFilters")[1].split("PushedFilters")[0]


def points(events):
    counted = hotspots.count_groups(events, [F.date_trunc("hour", "ts").alias("minute"), "key"])
    return counted.withColumn("metric", F.lit("count"))


@pytest.mark.parametrize("params,most", [(LONG, 2), (LONG.with_(scope="last"), 2), (DetectionParams(), 2), (LONG.with_(scope="last", mode="post_update"), 2)])
def test_a_fold_adds_one_shuffle_to_the_counts(events, params, most):
    found = detect_anomalies(points(events), params, top_k=None)
    for df in found:
        assert shuffles(df) == most, plan(df)
        assert NO_GROUPS_ON_ONE_TASK not in plan(df) and "PythonUDF" not in plan(df) and "Pandas" not in plan(df)


def test_stored_baselines_join_on_the_fold_partitioning(spark, events):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        saved = spark.createDataFrame([], detect_anomalies(points(events), LONG).baselines.schema)
        df = detect_anomalies(points(events), LONG, saved, top_k=None).findings
        assert shuffles(df) == 3, plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def above(text, what):
    """The operators between the scan that ``what`` names and the next join."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if what in line)
    depth, found = len(re.match(r"[\s:|+-]*", lines[at])[0]), []
    for line in reversed(lines[:at]):
        own = len(re.match(r"[\s:|+-]*", line)[0])
        if own < depth:
            depth = own
            found.append(line)
    return found


def test_bucketed_baselines_are_not_shuffled(spark, events, fresh):
    """Not for the series of a cycle, their newest rows, the join with its points, or compaction."""
    store = BaselineStore(spark, fresh("bucketed"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    early = detect_anomalies(points(events).where("minute < '2024-01-30'"), LONG).baselines
    store.append(early, "001")
    store.compact()
    store.append(early, "002")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        late = points(events).where("minute >= '2024-01-30'")
        active = of_active_series(store.history(), series.to_points(late))
        found = detect_anomalies(late, LONG, active, top_k=None)
        for df in (*found, store.load()):
            p = plan(df)
            way = above(p, "Bucketed: true")
            joined = next((i for i, line in enumerate(way) if "LeftOuter" in line), len(way))
            assert p.count("FileScan parquet spark_catalog") >= 1 and not any("Exchange" in line for line in way[:joined]), p
        plainly = BaselineStore(spark, fresh("plain"))
        for run in ("001", "002"):
            plainly.append(early, run)
        same = detect_anomalies(late, LONG, of_active_series(plainly.history(), series.to_points(late)), top_k=None)
        for a, b in zip(found, same):
            kept = [c for c in a.columns if c != "last_updated"]
            assert a.select(kept).exceptAll(b.select(kept)).count() == 0 and a.count() == b.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_blocks_bound_the_rows(events):
    blocks = series.to_blocks(series.by_series(series.to_points(points(events))), 0.3, 600)
    assert blocks.agg(F.max(F.size("points"))).first()[0] <= 10
    assert shuffles(blocks) == 2


def test_panes_are_counted_before_they_are_copied(events):
    p = plan(windows.sliding_counts(events, F.col("ts").cast("timestamp"), ["key"]))
    assert p.index("Generate") < p.index("partial_count(1)"), "the copy must sit above the first count"
    assert "Expand" not in p


def test_indicator_matching_never_shuffles_rows(events):
    short = Indicators.from_config({"cidrs": ["10.0.0.0/30"], "country": ["x"], "uri": ["y"], "regex": {"ua": ["z"]}})
    many = Indicators.from_config({"cidrs": [f"10.{i}.0.0/16" for i in range(200)], "country": [str(i) for i in range(500)]})
    for found, joins in ((short, 0), (many, 1)):
        df = indicators.match_all(events, found, ip="key", country="key", user_agent="key", uri="key")
        p = plan(df)
        assert shuffles(df) == 0 and p.count("BroadcastHashJoin") == joins, p
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
        assert p.count("ArrowEvalPython [") == joins, "one look-up for any number of prefix lengths"


def test_large_lists_are_not_broadcast(events, monkeypatch):
    monkeypatch.setattr("surgelens.session.BROADCAST_BYTES", 10)
    many = Indicators.from_config({"country": [f"10.0.0.{i}" for i in range(3, 500)]})
    spark = events.sparkSession
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = indicators.match_country(events, "key", many)
        assert "Broadcast" not in plan(df)
        assert df.where("country_rule IS NOT NULL").count() == events.where("cast(substring(key, 8) AS INT) >= 3").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_cycle_reads_its_counts_and_findings_not_the_logs(spark, fresh):
    path = fresh("counts")
    rows = spark.range(400).selectExpr(
        "'request_count' AS metric", "concat('10.0.0.', id % 5) AS key", "'/a' AS subkey", "id % 5 * 1.0 + id AS value",
        "timestamp_seconds(1706659200 + id * 60) AS minute", "'US' AS country", "'x' AS ua", "'WAF' AS source_type",
    )
    rows.write.parquet(path)
    found = detect_and_tag(series.to_points(spark.read.parquet(path)), LONG.with_(sigma=0.5, top_k=None), Indicators.from_config({"country": ["US"]}))
    p = plan(found.findings)
    # Details twice, the written findings thrice; the fold's windows are behind the written table.
    assert p.count("FileScan parquet") <= 5 and "Window" not in p and "counts-" in p and "untagged-" in p
    assert plan(found.baselines).count("FileScan parquet") == 1 and "states-" in plan(found.baselines)
    assert found.findings.where("ioc_matches IS NOT NULL").count() == found.findings.count() > 0
