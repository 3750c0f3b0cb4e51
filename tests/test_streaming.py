import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from surgelens.operators.scoring import score_points
from surgelens.params import DetectionParams
from surgelens.sources.baselines import BaselineStore
from surgelens.sources.schemas import WAF
from surgelens.sources.sinks import read_findings
from surgelens.streaming.baseline import scheduled_cycles, scored_stream
from surgelens.sources.storage import committed
from surgelens.streaming.counts import MARK, accounted_counts, closed_counts, late_rows, open_counts, to_parquet, windowed_counts
from surgelens.streaming.ingest import by_arrival, ingest_text
from surgelens.streaming.landing import landing_cycles

PARAMS = DetectionParams(min_count=2, sigma=1.0, scope="all")
SCHEMA = "minute timestamp, key string, subkey string, value double, metric string"


def batch(spark, path, first, values, key="k"):
    rows = [(dt.datetime(2024, 1, 1, 10, first + i), key, "s", float(v), "m") for i, v in enumerate(values)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_state_outlives_the_batch(spark, fresh):
    root = fresh("state")
    source, out, check = root + "/in", root + "/out", root + "/check"
    values = [10, 12, 11, 13, 90, 12, 11]
    for first, last in ((0, 4), (4, 7)):
        batch(spark, source, first, values[first:last])
        points = spark.readStream.schema(SCHEMA).parquet(source)
        to_parquet(scored_stream(points, PARAMS), out, check).awaitTermination()
    # A late repeat of folded minutes changes nothing.
    batch(spark, source, 2, [500, 500])
    to_parquet(scored_stream(spark.readStream.schema(SCHEMA).parquet(source), PARAMS), out, check).awaitTermination()
    got = spark.read.parquet(out).orderBy("minute").collect()
    whole = fresh("whole")
    batch(spark, whole, 0, values)
    want = score_points(spark.read.parquet(whole), PARAMS).orderBy("minute").collect()
    assert [r["value"] for r in got] == values
    for g, w in zip(got, want):
        assert g["score"] == (None if w["score"] is None else pytest.approx(w["score"]))


def test_idle_series_lose_their_state(spark, fresh):
    root = fresh("idle")
    source = root + "/in"
    for first, key, values in ((0, "gone", [10, 12, 11]), (0, "live", [10, 12, 11]), (30, "live", [11]), (31, "gone", [10, 13]), (32, "live", [12])):
        batch(spark, source, first, values, key)
        points = spark.readStream.schema(SCHEMA).parquet(source)
        to_parquet(scored_stream(points, PARAMS, idle_minutes=20, late="5 minutes"), root + "/out", root + "/check").awaitTermination()
    got = {(r["key"], r["minute"].minute): r["baseline_mean"] for r in spark.read.parquet(root + "/out").collect()}
    # The series that was away for more than 20 minutes starts anew; the one seen at 30 lives on.
    assert got["gone", 31] is None and got["gone", 32] == 10.0
    assert got["live", 32] is not None and got["live", 32] != 12.0
    rows = spark.read.format("statestore").option("path", root + "/check").option("stateVarName", "series").load()
    assert rows.count() == 2


def test_scheduled_cycles(spark, fresh):
    root = fresh("cycles")
    store = BaselineStore(spark, root + "/baselines")
    for first, values in ((0, [10, 12, 11, 13]), (4, [90, 12])):
        batch(spark, root + "/in", first, values)
        points = spark.readStream.schema(SCHEMA).parquet(root + "/in")
        scheduled_cycles(points, PARAMS, store, root + "/findings", root + "/check", once=True).awaitTermination()
    saved = store.load().first()
    whole = [10, 12, 11, 13, 90, 12]
    mean = whole[0]
    for v in whole[1:]:
        mean = 0.7 * mean + 0.3 * v
    assert saved["mean"] == pytest.approx(mean) and saved["n"] == 6
    found = read_findings(spark, root + "/findings").where("value = 90").first()
    assert found["mode"] == "high" and found["run_id"].endswith("-000000000001")


def test_late_records(spark, fresh):
    root = fresh("late")

    def land(*minutes):
        rows = [(dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=m), "a") for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, k string").coalesce(1).write.mode("append").parquet(root + "/in")
        stream = spark.readStream.schema("ts timestamp, k string").parquet(root + "/in")
        to_parquet(windowed_counts(stream, "ts", ["k"]), root + "/out", root + "/check").awaitTermination()

    land(0, 0, 1, 20)
    land(0, 18, 40)
    land(80)
    got = {f"{r['window_start']:%H:%M}": r["value"] for r in spark.read.parquet(root + "/out").collect()}
    assert got == {"10:00": 2, "10:01": 1, "10:18": 1, "10:20": 1, "10:40": 1}


def test_every_row_is_counted_or_refused(spark, fresh):
    root = fresh("accounted")
    landed = []

    def land(*minutes):
        rows = [(None if m is None else dt.datetime(2024, 1, 1, 10) + dt.timedelta(minutes=m), "a" if i % 2 else None, i) for i, m in enumerate(minutes)]
        landed.extend(rows)
        spark.createDataFrame(rows, "ts timestamp, k string, batch int").withColumnRenamed("batch", "extra").coalesce(1).write.mode("append").parquet(root + "/in")
        stream = spark.readStream.schema("ts timestamp, k string, extra int").parquet(root + "/in")
        accounted_counts(stream, "ts", ["k"], root, root + "/check").awaitTermination()

    land(0, 0, 1, 20, None)
    land(4.9, 5, 18, 40, 0)
    land(24.5, 25, 80)
    land(None)
    late = {(r["ts"].minute if r["ts"] else None, r["batch"]) for r in late_rows(spark, root).collect()}
    assert late == {(None, 0), (4, 1), (0, 1), (24, 2), (None, 3)}
    closed = {(f"{r['window_start']:%H:%M}", r["k"]): r["value"] for r in closed_counts(spark, root).collect()}
    left = {(f"{r['window_start']:%H:%M}", r["k"]): r["value"] for r in open_counts(spark, root).collect()}
    assert left == {("11:20", None): 1} and not closed.keys() & left.keys()
    assert closed[("10:25", "a")] == 1 and closed[("10:00", None)] == 1 and closed[("10:00", "a")] == 1
    assert sum(closed.values()) + sum(left.values()) + late_rows(spark, root).count() == len(landed)
    marks = spark.read.schema(MARK).parquet(*[f"{root}/marks/batch={b}" for b in committed(spark, root + "/marks", "batch")]).collect()
    assert sum(m["n_rows"] for m in marks) == len(landed) and sum(m["n_late"] for m in marks) == late_rows(spark, root).count()


def test_a_repeated_batch_counts_once(spark, fresh):
    root = fresh("repeated")
    rows = [(dt.datetime(2024, 1, 1, 10, m), "a") for m in (0, 1, 30)]
    for k, part in enumerate((rows, rows[:2] + rows[2:])):
        spark.createDataFrame(part, "ts timestamp, k string").coalesce(1).write.mode("append").parquet(root + "/in")
        stream = spark.readStream.schema("ts timestamp, k string").parquet(root + "/in")
        accounted_counts(stream, "ts", ["k"], root, root + "/check").awaitTermination()
        if k == 1:
            want = sorted(map(str, closed_counts(spark, root).collect())), sorted(map(str, open_counts(spark, root).collect()))
    # The commit of the last batch is lost, as if the driver had died before it.
    for name in ("1", ".1.crc"):
        os.rename(f"{root}/check/commits/{name}", f"{root}/lost{name}")
    accounted_counts(stream, "ts", ["k"], root, root + "/check").awaitTermination()
    assert (sorted(map(str, closed_counts(spark, root).collect())), sorted(map(str, open_counts(spark, root).collect()))) == want
    assert late_rows(spark, root).count() == 2


def test_landed_files_are_scored_by_closed_minutes(spark, fresh):
    """Two deliveries with a broken line, a late row and a batch that is repeated."""
    root, start = fresh("landing"), 1706659200
    store = BaselineStore(spark, root + "/baselines", 2)

    def land(name, requests, flows, extra=()):
        for kind, lines in (
            ("waf", [json.dumps({"timestamp": (start + 60 * m) * 1000, "httpRequest": {"clientIp": "1.1.1.1", "uri": "/a"}}) for m in requests]),
            ("vpc", [json.dumps({"start": start + 60 * m, "srcaddr": "2.2.2.2", "dstport": 22}) for m in flows]),
        ):
            folder = f"{root}/{kind}/dt=2024-01-31/hr=00"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/{name}.json", "w") as f:
                f.write("\n".join([*lines, *extra]) + "\n")
        run()

    def run():
        landing_cycles(spark, root + "/waf", root + "/vpc", PARAMS, store, root + "/counts", root + "/findings", root + "/check", once=True).awaitTermination()

    land("a", [0, 1, 1, 2, 20], [0, 1, 1, 2], ['{"timestamp": 17066, "bro'])
    land("b", [3, 9, 9, 9, 9, 9, 9, 9, 9, 9, 40], [9])
    rows = late_rows(spark, root + "/counts").collect()
    # Minute 3 comes behind the cutoff of minute 5; the broken line is in both logs.
    assert sorted((r["source_type"], r["key"] or "") for r in rows) == [("VPC", ""), ("WAF", ""), ("WAF", "1.1.1.1")]
    found = {(r["key"], r["minute"].minute, r["value"], r["mode"]) for r in read_findings(spark, root + "/findings").collect()}
    assert ("1.1.1.1", 9, 9.0, "high") in found
    saved = {r["key"]: r["n"] for r in store.load().collect()}
    assert saved == {"1.1.1.1": 5, "2.2.2.2": 4}
    want = {r["key"]: r["mean"] for r in store.load().collect()}
    for name in ("1", ".1.crc"):
        os.rename(f"{root}/check/commits/{name}", f"{root}/lost{name}")
    run()
    assert {r["key"]: r["mean"] for r in store.load().collect()} == want
    assert {(r["key"], r["minute"].minute, r["value"], r["mode"]) for r in read_findings(spark, root + "/findings").collect()} == found


def test_ingest_by_arrival(spark, fresh):
    root = fresh("ingest")
    os.makedirs(root + "/lines")
    with open(root + "/lines/a.txt", "w") as f:
        line = json.dumps({"timestamp": 5, "httpRequest": {"clientIp": "1.1.1.1"}, "unknown": {"field": [1, 2]}})
        f.write(line + "\nnot json\n")
    lines = spark.readStream.text(root + "/lines")
    for q in ingest_text(lines, WAF, root + "/ok", root + "/bad", root + "/check", once=True):
        q.awaitTermination()
    assert [r["value"] for r in spark.read.text(root + "/ok").collect()] == [line]
    landed = spark.read.json(root + "/ok")
    assert landed.select("httpRequest.clientIp").collect()[0][0] == "1.1.1.1"
    assert {"dt", "hr"} <= set(landed.columns)
    assert [r["value"] for r in spark.read.text(root + "/bad").collect()] == ["not json"]
    assert any(n.endswith(".txt.gz") for _, _, names in os.walk(root + "/ok") for n in names)
    assert by_arrival(spark.range(1)).where(F.col("hr").rlike("^[0-9]{2}$")).count() == 1
