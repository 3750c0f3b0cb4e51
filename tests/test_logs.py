import datetime as dt
import gzip
import json
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from surgelens.functions import scalars as X
from surgelens.operators import hotspots, slices, windows
from surgelens.sources import convert, logs
from surgelens.sources.convert import (
    convert_day, convert_new, converted_files, expired_days, expired_partitions, write_partitioned,
)
from surgelens.sources.schemas import VPC, WAF
from surgelens.sources.sqljob import fill_places, run_sql, run_sql_file
from surgelens.sources.storage import list_files, list_partitions
from surgelens.sources.tables import create_database, register_external

AS_OF = dt.datetime(2023, 10, 27, 0, 5, tzinfo=dt.timezone.utc)
MIDNIGHT = 1698364800


def write_lines(root, day, hour, lines, name="part.json.gz"):
    folder = os.path.join(root, f"dt={day}", f"hr={hour}")
    os.makedirs(folder, exist_ok=True)
    with gzip.open(os.path.join(folder, name), "wt") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def request(second, ip="10.0.0.77", uri="/kelp/dock", labels=(), agent="Gullprobe/3.2", ms=0, **more):
    headers = [{"name": "Host", "value": "h"}]
    if agent:
        headers.append({"name": "User-Agent", "value": agent})
        headers.append({"name": "User-Agent", "value": "second"})
    return {
        "timestamp": (MIDNIGHT + second) * 1000 + ms,
        "formatVersion": 1,
        "webaclId": "acl",
        "terminatingRule": {"ruleId": "rule-id-1", "action": "ALLOW"},
        "httpRequest": {"clientIp": ip, "country": "US", "headers": headers, "uri": uri, **more},
        "labels": [{"name": x} for x in labels],
    }


def flow(second, dashed, port=443, action="ACCEPT"):
    join = "-" if dashed else "_"
    return {
        "version": 2, f"account{join}id": "1", f"interface{join}id": "eni", "srcaddr": "172.20.4.9", "dstaddr": "10.0.0.1",
        "srcport": 1025, "dstport": port, "protocol": 6, "packets": 1, "bytes": 10, "start": MIDNIGHT + second,
        "end": MIDNIGHT + second + 5, "action": action, f"log{join}status": "OK",
    }


@pytest.fixture()
def waf(spark, fresh):
    root = fresh("waf")
    write_lines(root, "2023-10-26", "03", [request(-75600)])
    write_lines(root, "2023-10-26", "23", [
        request(-601), request(-60, ms=999, method="GET"), request(-59, labels=["a", "b"]), '{"timestamp": 1, "bro',
    ])
    write_lines(root, "2023-10-27", "00", [request(-30, agent=None), request(60, httpMethod="PUT"), request(61)])
    return root


@pytest.fixture()
def vpc(spark, fresh):
    root = fresh("vpc")
    write_lines(root, "2023-10-26", "23", [flow(-100, True), flow(-90, False), flow(-3000, True)])
    write_lines(root, "2023-10-27", "00", [flow(10, False, 22), flow(11, True, 22, "REJECT")])
    return root


def test_scan_types_and_spellings(spark, waf, vpc):
    df = logs.read_waf(spark, waf)
    assert dict(df.dtypes)["dt"] == "string" and dict(df.dtypes)["hr"] == "string"
    assert sorted(r[0] for r in df.select("hr").distinct().collect()) == ["00", "03", "23"]
    methods = df.select("httpRequest.httpMethod").where("httpMethod is not null").collect()
    assert sorted(r[0] for r in methods) == ["GET", "PUT"]
    flows = logs.read_vpc(spark, vpc)
    assert len(flows.columns) == 31 and flows.where("account_id = '1' and log_status = 'OK'").count() == 5
    assert flows.where("traffic_path is not null").count() == 0


def test_broken_lines_do_not_stop_the_scan(spark, waf):
    df = logs.read_waf(spark, waf, keep_corrupt=True)
    assert logs.well_formed(df).count() == 7
    bad = logs.quarantined(df).collect()
    assert logs.quarantined(df).select("_corrupt_record").count() == 1
    assert [r["_corrupt_record"] for r in bad] == ['{"timestamp": 1, "bro']
    assert slices.slice_waf(logs.read_waf(spark, waf), AS_OF, 60 * 24 * 2).count() == 7


def without_nulls(x):
    if isinstance(x, dict):
        return {k: without_nulls(v) for k, v in x.items() if v is not None}
    return [without_nulls(v) for v in x] if isinstance(x, list) else x


@pytest.mark.parametrize("kind", ["waf", "vpc"])
def test_records_come_back_whole(spark, fresh, kind):
    """Unknown fields at every depth, through Parquet."""
    root, odd = fresh("whole"), {"a": [1, {"b": 2.5}], "c": {"d": True}, "e": "x'y.z"}
    if kind == "waf":
        deep = request(3, labels=["l"], httpMethod="PUT", weird=odd, host="h")
        deep["httpRequest"]["headers"][1]["seen"] = 3
        deep["terminatingRule"]["ruleMatchDetails"] = [{"location": "A", "matchedData": ["x", "y"], "more": odd}, {"conditionType": "B"}]
        only = {"httpRequest": {"new": 1}, "dt": "in the record", "labels": []}
        lines = [request(1), deep, {**request(2), "top": odd, "many": [odd, 7]}, only, {"other": {}}, {}]
    else:
        lines = [flow(1, False), {**flow(2, False, 22), "ecs-task": "t", "odd": odd, "traffic_path": [1, 2]}, {"x": "y"}]
    write_lines(root, "2023-10-27", "00", [*lines, ""])
    read = logs.read_waf if kind == "waf" else logs.read_vpc
    stored = fresh("whole-stored")
    read(spark, root, keep_unknown=True).write.parquet(stored)
    rows = spark.read.parquet(stored)
    got = [json.loads(r[0]) for r in rows.select(F.to_json(logs.whole_record(rows))).collect()]
    key = lambda x: json.dumps(x, sort_keys=True)
    assert sorted(got, key=key) == sorted((without_nulls(x) for x in lines), key=key)
    plain = read(spark, root)
    assert rows.select(plain.columns).where("dt IS NOT NULL").exceptAll(plain).count() == 0 and rows.count() == len(lines)
    assert rows.where(F.col("unknown_fields").isNotNull()).count() == (4 if kind == "waf" else 2)


def test_conversion_keeps_unknown_fields(spark, fresh):
    root, target = fresh("unknown"), fresh("unknown-converted")
    write_lines(root, "2023-10-27", "00", [request(1), {**request(2), "top": [1]}, '{"bro'])
    read = partial(logs.read_waf, keep_unknown=True)
    assert convert_new(spark, read, root, target) == 1
    kept = logs.read_waf(spark, target, fmt="parquet", keep_unknown=True)
    assert [r[0] for r in kept.select(F.to_json("unknown_fields")).where("unknown_fields IS NOT NULL").collect()] == ['{"top":[1]}']
    assert [r["_corrupt_record"] for r in logs.quarantined(kept).collect()] == ['{"bro']
    assert logs.read_waf(spark, target, fmt="parquet").where("httpRequest IS NOT NULL").count() == 2


def test_lines_that_cannot_be_kept_by_field_are_kept_as_text(spark, fresh):
    root = fresh("odd-lines")
    lines = ['{"timestamp": 1, "bro', '{"timestamp": "soon", "z": 1}', '{"z": 1, "z": 2, "timestamp": 3}', "[1]", "null", '{"timestamp": 4}']
    write_lines(root, "2023-10-27", "00", lines)
    df = logs.read_waf(spark, root, keep_unknown=True)
    assert sorted(r[0] for r in df.where("_corrupt_record IS NOT NULL").select("_corrupt_record").collect()) == sorted(lines[:-1])
    assert [r["timestamp"] for r in df.where("_corrupt_record IS NULL").collect()] == [4]
    assert df.where("_corrupt_record IS NOT NULL AND (timestamp IS NOT NULL OR unknown_fields IS NOT NULL)").count() == 0
    write_lines(fresh("no"), "2023-10-27", "00", [])
    assert "PartitionFilters: [isnotnull(hr" in df.where("hr = '00'")._jdf.queryExecution().executedPlan().toString()


def test_lookback_across_midnight(spark, waf, vpc):
    df = logs.read_waf(spark, waf)
    counts = hotspots.waf_counts(df, AS_OF, 15)
    got = {(f"{r['minute']:%H:%M}", r["rule_label"]): r["value"] for r in counts.collect()}
    assert got == {("23:59", None): 2, ("23:59", "a"): 1, ("00:01", None): 2}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    files = df.where(slices.partition_range(AS_OF, 15)).inputFiles()
    assert len(files) in (2, 3)
    flows = hotspots.vpc_counts(logs.read_vpc(spark, vpc), AS_OF, 15, extra=["action"])
    assert sorted((r["subkey"], r["action"], r["value"]) for r in flows.collect()) == [
        (22, "ACCEPT", 1), (22, "REJECT", 1), (443, "ACCEPT", 2),
    ]


def test_slices(spark, waf, vpc):
    rows = slices.slice_waf(logs.read_waf(spark, waf), AS_OF, 120).orderBy("event_time").collect()
    assert [r["user_agent"] for r in rows] == ["Gullprobe/3.2"] * 3 + [None] + ["Gullprobe/3.2"] * 2
    assert rows[1]["event_time"].second == 0 and rows[2]["label"] == "a" and rows[0]["label"] is None
    assert rows[0]["rule_action"] == "ALLOW"
    slices.register_views(logs.read_waf(spark, waf), logs.read_vpc(spark, vpc), AS_OF)
    assert spark.sql("SELECT count(*) FROM slice_vpc WHERE end_time > start_time").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM slice_waf").first()[0] == 6


def test_lookback_for_both_timestamp_types(spark):
    df = spark.sql(
        "SELECT TIMESTAMP_NTZ'2023-10-27 00:00:00' AS n, TIMESTAMP'2023-10-27 00:00:00' AS t UNION ALL"
        " SELECT TIMESTAMP_NTZ'2023-10-26 23:49:59', TIMESTAMP'2023-10-27 00:05:01'"
    )
    assert slices.lookback(df, "n", AS_OF, 15).count() == 1
    assert slices.lookback(df, "t", AS_OF, 15).count() == 1


def test_hotspot_limits_and_order(spark, waf, vpc):
    w, v = logs.read_waf(spark, waf), logs.read_vpc(spark, vpc)
    both = hotspots.union_hotspots(w, v, AS_OF, 15, 2).collect()
    assert [(f"{r['minute']:%H:%M}", r["source_type"], r["value"]) for r in both] == [
        ("23:58", "VPC", 2), ("23:59", "WAF", 2), ("00:00", "VPC", 2), ("00:01", "WAF", 2),
    ]
    top = hotspots.waf_hotspots(w, AS_OF, 15, 3).collect()
    assert [r["value"] for r in top] == [2, 2, 1] and top[0]["metric"] == "request_count"
    assert hotspots.vpc_hotspots(v, AS_OF, 15, 10).count() == 3


def test_feature_key(spark):
    df = spark.createDataFrame([("1.1.1.1", None, "ua"), (None, None, None)], "ip string, country string, ua string")
    keys = df.select(X.feature_key([F.col("ip"), F.col("country"), F.col("ua")])).collect()
    assert [k[0] for k in keys] == ["1.1.1.1||ua", "||"]


def test_sliding_counts_equal_the_window_function(spark):
    df = spark.range(500).select(F.timestamp_seconds(1_700_000_000 + F.col("id") * 37).alias("ts"), (F.col("id") % 3).alias("k"))
    want = df.groupBy(F.window("ts", "15 minutes", "5 minutes")["start"].alias("window_start"), "k").agg(F.count("*").alias("value"))
    got = windows.sliding_counts(df, F.col("ts"), ["k"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    with pytest.raises(ValueError):
        windows.sliding_counts(df, F.col("ts"), ["k"], 15, 4)


def test_a_late_file_has_its_hour_converted_again(spark, waf, fresh):
    source, out = fresh("late"), fresh("late-parquet")
    rows = logs.read_waf(spark, waf)
    write_partitioned(rows, source, fmt="json")
    hours = convert_new(spark, logs.read_waf, source, out)
    assert hours == 3 and convert_new(spark, logs.read_waf, source, out) == 0
    write_partitioned(rows.where("hr = '23'").limit(1), source, fmt="json")
    assert convert_new(spark, logs.read_waf, source, out) == 1
    assert logs.read_waf(spark, out, "parquet").count() == rows.count() + 1


@pytest.mark.parametrize("seen_by_the_scan", [True, False])
def test_a_file_that_lands_during_a_run_is_converted_once(spark, waf, fresh, seen_by_the_scan):
    source, out = fresh("during"), fresh("during-parquet")
    rows = logs.read_waf(spark, waf)
    write_partitioned(rows, source, fmt="json")
    late = rows.where("hr = '23'").limit(1)

    def read(spark, path):
        if seen_by_the_scan:
            write_partitioned(late, source, fmt="json")
            return logs.read_waf(spark, path)
        before = logs.read_waf(spark, path)
        before.count()
        write_partitioned(late, source, fmt="json")
        return before

    assert convert_new(spark, read, source, out) == 3
    assert logs.read_waf(spark, out, "parquet").count() == rows.count() + seen_by_the_scan
    assert convert_new(spark, logs.read_waf, source, out) == 1
    assert logs.read_waf(spark, out, "parquet").count() == rows.count() + 1
    assert convert_new(spark, logs.read_waf, source, out) == 0
    assert converted_files(spark, out).where("hr = '23'").count() >= 2


def test_a_run_that_is_lost_before_its_manifest_is_done_again(spark, waf, fresh, monkeypatch):
    source, out = fresh("lost"), fresh("lost-parquet")
    rows = logs.read_waf(spark, waf)
    write_partitioned(rows, source, fmt="json")
    with monkeypatch.context() as patched:
        patched.setattr(convert, "_record", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            convert_new(spark, logs.read_waf, source, out)
    assert convert_new(spark, logs.read_waf, source, out) == 3
    assert logs.read_waf(spark, out, "parquet").count() == rows.count()


def test_an_hour_whose_files_are_gone_is_not_rewritten(spark, waf, fresh):
    source, out = fresh("gone"), fresh("gone-parquet")
    rows = logs.read_waf(spark, waf)
    write_partitioned(rows, source, fmt="json")
    convert_new(spark, logs.read_waf, source, out)
    first = [f for f, *_, hr in list_files(spark, source, "dt", "hr") if hr == "23"][0]
    local = first.removeprefix("file:")
    os.rename(local, os.path.join(os.path.dirname(local), "_archived"))
    write_partitioned(rows.where("hr = '23'").limit(1), source, fmt="json")
    with pytest.raises(RuntimeError, match="gone"):
        convert_new(spark, logs.read_waf, source, out)
    assert logs.read_waf(spark, out, "parquet").count() == rows.count()


def test_conversion(spark, waf, fresh):
    out = fresh("parquet")
    assert convert_day(spark, logs.read_waf, waf, out, "2023-10-26") == 2
    assert convert_day(spark, logs.read_waf, waf, out, "2023-10-25") == 0
    assert list_partitions(spark, out, "dt", "hr") == [("2023-10-26", "03"), ("2023-10-26", "23")]
    assert convert_new(spark, logs.read_waf, waf, out) == 1
    assert convert_new(spark, logs.read_waf, waf, out) == 0
    back = logs.read_waf(spark, out, "parquet")
    assert back.schema == logs.read_waf(spark, waf).schema and back.count() == 8
    convert_day(spark, logs.read_waf, waf, out, "2023-10-26", mode="replace")
    assert logs.read_waf(spark, out, "parquet").count() == 8
    convert_day(spark, logs.read_waf, waf, out, "2023-10-26")
    assert logs.read_waf(spark, out, "parquet").count() == 13
    assert hotspots.waf_counts(logs.read_waf(spark, out, "parquet"), AS_OF, 15).count() == 3
    with pytest.raises(ValueError):
        convert_day(spark, logs.read_waf, waf, out, "26.10.2023")


def test_hot_hour_is_split_over_files(spark, fresh):
    path = fresh("hot")
    df = spark.range(60_000).select(
        "id", F.md5(F.col("id").cast("string")).alias("x"), F.lit("2023-10-26").alias("dt"),
        F.when(F.col("id") % 3 == 0, "00").otherwise(F.lpad((F.col("id") % 24).cast("string"), 2, "0")).alias("hr"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        write_partitioned(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = spark.read.parquet(path).inputFiles()
    assert sum("hr=00" in f for f in files) > 1
    assert spark.read.parquet(path).count() == 60_000


def test_retention_by_folder(spark, waf):
    assert expired_days(spark, waf, AS_OF.date(), 0) == ["2023-10-26"]
    assert expired_days(spark, waf, AS_OF.date(), 1) == []


def test_retention(spark):
    df = spark.createDataFrame([("2023-07-01",), ("2023-07-01",), ("2023-10-20",)], "dt string")
    got = expired_partitions(df, AS_OF.date(), 90).collect()
    assert [(r["dt"], r["n_rows"]) for r in got] == [("2023-07-01", 2)]


def test_catalog(spark, waf, vpc, fresh):
    create_database(spark, "surgelens_t", fresh("db"))
    create_database(spark, "surgelens_t")
    name = register_external(spark, "surgelens_t", "waf_logs", WAF, waf)
    register_external(spark, "surgelens_t", "vpc_logs", VPC, vpc)
    got = run_sql(
        spark,
        "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE dt = :day AND hr >= '23' AND timestamp > 1",
        args={"t": name, "day": "2023-10-26"},
    )
    assert got.first()["n"] == 3
    assert spark.table("surgelens_t.vpc_logs").where("hr = '00'").count() == 2


def test_sql_job(spark, tmp_path):
    spark.range(10).createOrReplaceTempView("job_numbers")
    path = tmp_path / "job.sql"
    path.write_text("SELECT id FROM `job_${SUFFIX}` WHERE id >= :low ORDER BY id LIMIT ${TOP_K};\n")
    got = run_sql_file(spark, str(path), args={"low": 4}, places={"SUFFIX": "numbers", "TOP_K": 3})
    assert [r["id"] for r in got.collect()] == [4, 5, 6]
    with pytest.raises(KeyError):
        fill_places("${none}", {})
    for bad in ("1; DROP TABLE x", "a`b", "", "a b", "x\n"):
        with pytest.raises(ValueError):
            fill_places("${x}", {"x": bad})


def test_records_are_taken_apart_once_per_level(spark):
    """Rebuilding looks into a level's unknown fields by path, not by one map of all of
    them per field: seven levels, at most two looks each."""
    schema = logs._stored(logs.canonical_waf(logs.empty(spark, WAF)).schema, True)
    rows = logs.empty(spark, schema)
    plan = rows.select(logs.whole_record(rows))._jdf.queryExecution().analyzed().toString()
    assert 7 <= plan.count("MapType(StringType,VariantType") <= 14
