import json

import pytest
from pyspark.sql import functions as F

from surgelens.operators import alerts
from surgelens.sources.baselines import BaselineStore, of_active_series, upsert
from surgelens.sources.sinks import read_findings, write_findings

ROW = "metric string, key string, subkey string, mean double, std double, at string"
FINDING = (
    "key string, subkey string, minute timestamp, value double, score double, baseline_mean double,"
    " baseline_std double, metric string, mode string, ioc_matches array<string>"
)


def baselines(spark, *rows):
    df = spark.createDataFrame([("m", *r) for r in rows], ROW)
    return df.select(
        "metric", "key", "subkey", "mean", "std", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("double").alias("c"),
        F.lit(None).cast("double").alias("q"), F.col("at").cast("timestamp").alias("last_minute"),
        F.col("at").cast("timestamp").alias("last_updated"), F.lit(None).cast("string").alias("run_id"),
    )


def means(df):
    return {r["key"]: r["mean"] for r in df.collect()}


@pytest.mark.parametrize("buckets", [None, 3])
def test_store(spark, fresh, buckets):
    store = BaselineStore(spark, fresh("store"), buckets)
    assert store.load().count() == 0 and store.compact() is None
    store.append(baselines(spark, ("a/b", "s", 100.5, 10.2, "2024-01-01"), ("b", "s", 1.0, 1.0, "2024-01-01")), "1")
    store.append(baselines(spark, ("a/b", "s", 105.0, 11.0, "2024-01-02")), "2")
    assert means(store.load()) == {"a/b": 105.0, "b": 1.0}
    assert means(store.load(before="2")) == {"a/b": 100.5, "b": 1.0}
    assert store.compact() == "2"
    assert store.compact() == "2" and store.open_runs() == 0
    assert means(store.load()) == {"a/b": 105.0, "b": 1.0}
    store.append(baselines(spark, ("b", "s", 7.0, 1.0, "2024-01-03")), "3")
    store.append(baselines(spark, ("b", "s", 8.0, 1.0, "2024-01-03")), "3")
    assert means(store.load()) == {"a/b": 105.0, "b": 8.0}
    assert means(store.load(before="3")) == {"a/b": 105.0, "b": 1.0}
    assert store.load().columns == baselines(spark, ("x", "s", 1.0, 1.0, "2024-01-01")).columns
    with pytest.raises(ValueError):
        store.append(store.load(), "../x")


def test_buckets_belong_to_the_store(spark, fresh):
    path = fresh("store")
    BaselineStore(spark, path, 3).append(baselines(spark, ("a", "s", 1.0, 1.0, "2024-01-01")), "1")
    again = BaselineStore(spark, path)
    assert again.buckets == 3 and means(again.load()) == {"a": 1.0}
    again.append(baselines(spark, ("a", "s", 2.0, 1.0, "2024-01-02"), (None, "s", 3.0, 1.0, "2024-01-02")), "2")
    assert means(BaselineStore(spark, path, 3).load()) == {"a": 2.0, None: 3.0}
    assert means(BaselineStore(spark, path).load(before="2")) == {"a": 1.0}
    with pytest.raises(ValueError):
        BaselineStore(spark, path, 4)
    plain = fresh("store")
    BaselineStore(spark, plain).append(baselines(spark, ("a", "s", 1.0, 1.0, "2024-01-01")), "1")
    with pytest.raises(ValueError):
        BaselineStore(spark, plain, 4)
    # Tables made to write a run are gone; the store's own stays.
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("baselines_")]
    assert len(left) == len(set(left)) and not any(spark.table(t).columns[-1] != "run" for t in left)


def test_a_run_without_its_marker_is_not_read(spark, fresh):
    from surgelens.sources.storage import remove

    store = BaselineStore(spark, fresh("store"), 2)
    store.append(baselines(spark, ("a", "s", 1.0, 1.0, "2024-01-01")), "1")
    store.append(baselines(spark, ("a", "s", 2.0, 1.0, "2024-01-02")), "2")
    remove(spark, f"{store.delta}/run=2/_SUCCESS")
    assert means(store.load()) == {"a": 1.0}


@pytest.mark.parametrize("buckets", [None, 2])
def test_compaction_removes_what_an_older_base_covers(spark, fresh, buckets):
    from surgelens.sources.storage import committed

    store = BaselineStore(spark, fresh("store"), buckets)
    for run in range(1, 10):
        store.append(baselines(spark, (f"k{run % 4}", "s", float(run), 1.0, "2024-01-01")), f"{run:03d}")
        if run % 3 == 0:
            store.compact()
    assert committed(spark, store.base, store.key) == ["006", "009"]
    assert committed(spark, store.delta, store.key) == ["007", "008", "009"]
    assert means(store.load()) == {"k0": 8.0, "k1": 9.0, "k2": 6.0, "k3": 7.0}
    # A run that is repeated still reads what was there before it.
    assert means(store.load(before="008")) == {"k0": 4.0, "k1": 5.0, "k2": 6.0, "k3": 7.0}
    assert means(store.load(before="009")) == {"k0": 8.0, "k1": 5.0, "k2": 6.0, "k3": 7.0}


@pytest.mark.parametrize("buckets", [None, 2])
def test_only_active_series_are_read_on(spark, fresh, buckets):
    store = BaselineStore(spark, fresh("store"), buckets)
    store.append(baselines(spark, ("a", "s", 1.0, 1.0, "2024-01-01"), ("b", "s", 2.0, 1.0, "2024-01-01")), "1")
    store.append(baselines(spark, ("b", "s", 3.0, 1.0, "2024-01-02")), "2")
    active = baselines(spark, ("b", "s", 0.0, 0.0, "2024-01-01"), ("c", "s", 0.0, 0.0, "2024-01-01"))
    rows = of_active_series(store.history(), active).orderBy("run_id").collect()
    assert [(r["series"]["key"], r["mean"], r["run_id"]) for r in rows] == [("b", 2.0, "1"), ("b", 3.0, "2")]


def test_upsert(spark):
    old = baselines(spark, ("a", "s", 1.0, 1.0, "2024-01-01"), ("b", "s", 2.0, 1.0, "2024-01-01"))
    new = baselines(spark, ("b", "s", 3.0, 1.0, "2024-01-02"), ("c", "s", 4.0, 1.0, "2024-01-02"))
    assert means(upsert(old, new)) == {"a": 1.0, "b": 3.0, "c": 4.0}


def findings(spark, rows):
    return spark.createDataFrame(rows, FINDING)


@pytest.fixture()
def two(spark):
    import datetime as dt

    at = dt.datetime(2023, 10, 26, 10, 0)
    return findings(
        spark,
        [
            ("5.6.7.8", "N/A", at, 500.5, -3.2, 100.0, 10.0, "connections", "low", None),
            ("1.1.1.1", "/pathA", at, 100.0, 4.5, 20.0, 5.0, "request_count", "high", ["CIDR:1.1.1.0/24", "Country:KP"]),
        ],
    )


def test_chat_digest(spark, two):
    message = json.loads(alerts.chat_digest(two, {"timestamp": "now", "source": "s"}, 10).first()["message"])
    kinds = [b["type"] for b in message["blocks"]]
    assert kinds == ["header", "section", "divider", "section", "context", "divider", "section", "divider"]
    assert message["blocks"][0]["text"]["text"] == "🚨 Log anomaly detected (2 findings) 🚨"
    assert message["blocks"][1]["text"]["text"] == "*Detection Time:* now\n*Source:* s"
    assert message["blocks"][3]["text"]["text"] == (
        "*1. Metric:* `request_count`\n*Key:* `1.1.1.1`\n*Subkey:* `/pathA`\n*Value:* `100`\n"
        "*Score (Sigma):* `4.50` (high)\n*Baseline Mean:* `20.00`\n*Baseline StdDev:* `5.00`\n"
    )
    assert message["blocks"][4]["elements"] == [{"type": "mrkdwn", "text": "*IOC Matches:* CIDR:1.1.1.0/24, Country:KP"}]
    assert "*Value:* `500.5`" in message["blocks"][6]["text"]["text"]
    one = json.loads(alerts.chat_digest(two, {}, 1).first()["message"])
    assert "(1 findings)" in one["blocks"][0]["text"]["text"] and one["blocks"][1]["text"]["text"].endswith("`N/A`"[1:-1])
    quiet = json.loads(alerts.chat_digest(two.limit(0), {}, 10).first()["message"])
    assert quiet == {"text": "No anomalies detected."}


def test_missing_numbers_are_named(spark):
    import datetime as dt

    df = findings(spark, [("k", "s", dt.datetime(2023, 1, 1), None, 4.0, None, None, "m", "high", None)])
    text = alerts.alert_rows(df, 5).first()["text"]
    assert "*Value:* `N/A`" in text and "*Baseline Mean:* `N/A`" in text


def test_alert_document(spark, two):
    row = alerts.alert_document(two, {"source": "s"}, "2023-10-26T10:00:00Z", 10).first()
    body = json.loads(row["message"])
    assert body["subject"] == row["subject"] == "Log anomaly detected (2 findings)"
    assert [f["key"] for f in body["findings"]] == ["1.1.1.1", "5.6.7.8"]
    assert body["context"] == {"source": "s"} and body["timestamp"] == "2023-10-26T10:00:00Z"
    empty = json.loads(alerts.alert_document(two.limit(0), {}, "t", 10).first()["message"])
    assert empty["findings"] == []


def test_metric_record(spark, two):
    record = json.loads(alerts.metric_record(two, "Space", {"Detector": "d", "Source": "s"}, 123).first()["record"])
    assert record["_aws"]["Timestamp"] == 123
    directive = record["_aws"]["CloudWatchMetrics"][0]
    assert directive["Namespace"] == "Space" and directive["Dimensions"] == [["Detector", "Source"]]
    assert directive["Metrics"] == [{"Name": "AnomalyCount", "Unit": "Count"}, {"Name": "MaxAnomalyScore", "Unit": "Count"}]
    assert (record["Detector"], record["Source"], record["AnomalyCount"], record["MaxAnomalyScore"]) == ("d", "s", 2, 4.5)
    none = json.loads(alerts.metric_record(two.limit(0), "Space", {"Detector": "d"}, 1).first()["record"])
    assert (none["AnomalyCount"], none["MaxAnomalyScore"]) == (0, 0.0)


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_finding_sink_is_repeatable(spark, two, fresh, fmt):
    path = fresh("findings")
    write_findings(two, path, "1", fmt)
    write_findings(two, path, "1", fmt)
    write_findings(two.limit(1), path, "2", fmt)
    saved = read_findings(spark, path, fmt)
    assert [tuple(r) for r in saved.groupBy("run_id").count().orderBy("run_id").collect()] == [("1", 2), ("2", 1)]
    assert {r["dt"] for r in saved.collect()} == {"2023-10-26"}
    quiet = fresh("quiet")
    write_findings(two.limit(0), quiet, "1", fmt)
    assert read_findings(spark, quiet, fmt).count() == 0
