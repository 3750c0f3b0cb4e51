"""The named queries. ``QUERIES`` maps a name to its Spark function, ``ORACLES``
to the SQL that gives the same rows; times are text and doubles are rounded."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.functions import scalars as X
from surgelens.functions.smoothing import zscore
from surgelens.operators import alerts, changes, hotspots, indicators, scoring, series, slices, windows
from surgelens.operators.alerts import METRICS
from surgelens.params import DetectionParams
from surgelens.plans.detection import detect_and_tag, plan_cycle, run_cycle
from surgelens.registry import tables as T
from surgelens.session import broadcast_within, scratch_path, written
from surgelens.sources import convert, logs, sqljob
from surgelens.sources import tables as catalog
from surgelens.sources.baselines import KEYS, BaselineStore, newest_per_series, of_active_series, upsert
from surgelens.sources.indicators import Indicators, load_indicators
from surgelens.sources.schemas import VPC, WAF
from surgelens.sources.sinks import read_findings
from surgelens.streaming import baseline as stream_baseline
from surgelens.streaming import counts as stream_counts
from surgelens.streaming import ingest as stream_ingest
from surgelens.streaming import landing as stream_landings

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOP_K = 100
SECOND = "yyyy-MM-dd HH:mm:ss"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


def when_text(column: str) -> Column:
    return F.date_format(column, SECOND).alias(column)


def rounded(column: str) -> Column:
    return F.round(column, 6).alias(column)


# ---------------------------------------------------------------- filters, views

LAST_EVENT = dt.datetime(2024, 1, 30, 23, 57, 12, tzinfo=dt.timezone.utc)
UNTIL = "TIMESTAMP '2024-01-30 23:57:12'"


@query(
    "lookback_filter",
    f"""SELECT event_id, user_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events
    WHERE ts >= {UNTIL} - INTERVAL 1 DAY AND ts <= {UNTIL}""",
)
def lookback_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = slices.lookback(T.table(spark, sf, "events"), "ts", LAST_EVENT, 24 * 60)
    return rows.select("event_id", "user_id", "event_type", when_text("ts"))


@query(
    "partition_range",
    f"""WITH {T.LOG_SQL}
    SELECT strftime(log_time, '%Y-%m-%d') AS dt, strftime(log_time, '%H') AS hr, count(*) AS n_rows FROM log
    WHERE log_time >= TIMESTAMP '2024-01-30 20:00:00' GROUP BY ALL""",
)
def partition_range(spark: SparkSession, sf: str) -> DataFrame:
    files = logs.read_waf(spark, T.landed(spark, sf, "waf"))
    return files.where(slices.partition_range(T.AS_OF, 240)).groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "slice_waf",
    f"""WITH {T.LOG_SQL}
    SELECT strftime(log_time, '%Y-%m-%d %H:%M:%S') AS event_time, ip AS client_ip, country, ua AS user_agent, uri,
           CASE WHEN event_type = 'error' THEN 'BLOCK' ELSE 'ALLOW' END AS rule_action,
           'rule-' || (k % 3) AS rule_id, label FROM log""",
)
def slice_waf(spark: SparkSession, sf: str) -> DataFrame:
    files = logs.read_waf(spark, T.landed(spark, sf, "waf"))
    rows = slices.slice_waf(files, T.AS_OF, T.LOG_MINUTES)
    return rows.withColumn("event_time", when_text("event_time"))


FLOW_SQL = """SELECT strftime(log_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(log_time + INTERVAL 5 SECOND, '%Y-%m-%d %H:%M:%S') AS end_time,
       ip AS srcaddr, '10.1.0.' || k AS dstaddr, CAST(1024 + event_id % 60000 AS INTEGER) AS srcport,
       CAST(CASE event_id % 4 WHEN 0 THEN 22 WHEN 1 THEN 80 WHEN 2 THEN 443 ELSE 3389 END AS INTEGER) AS dstport,
       CAST(CASE WHEN event_id % 10 = 0 THEN 17 ELSE 6 END AS BIGINT) AS protocol,
       CAST(k AS BIGINT) AS packets, CAST(k * 100 AS BIGINT) AS bytes,
       CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'ACCEPT' END AS action, 'OK' AS log_status FROM log"""


@query("slice_vpc", f"WITH {T.LOG_SQL} {FLOW_SQL}")
def slice_vpc(spark: SparkSession, sf: str) -> DataFrame:
    flows = logs.read_vpc(spark, T.landed(spark, sf, "vpc"))
    rows = slices.slice_vpc(flows, T.AS_OF, T.LOG_MINUTES)
    return rows.withColumns({"start_time": when_text("start_time"), "end_time": when_text("end_time")})


@query(
    "json_field",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def json_field(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.from_json("props", "k INT")
    return T.table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "waf_json_scan",
    f"""WITH {T.LOG_SQL}
    SELECT ip AS client_ip, country, uri, 'GET' AS method, 200 AS status, ua AS user_agent, count(*) AS n_rows,
           CAST(count(label) AS BIGINT) AS n_labelled
    FROM log GROUP BY ip, country, uri, ua""",
)
def waf_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    files = logs.read_waf(spark, T.landed(spark, sf, "waf"))
    keys = [
        F.col("httpRequest.clientIp").alias("client_ip"),
        F.col("httpRequest.country").alias("country"),
        F.col("httpRequest.uri").alias("uri"),
        F.col("httpRequest.httpMethod").alias("method"),
        F.col("httpResponse.status").alias("status"),
        X.header_value(F.col("httpRequest.headers"), "User-Agent").alias("user_agent"),
    ]
    return files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(X.first_label(F.col("labels"))).alias("n_labelled")
    )


@query(
    "vpc_json_scan",
    f"""WITH {T.LOG_SQL}, flow AS ({FLOW_SQL})
    SELECT '123456789012' AS account_id, 'eni-1' AS interface_id, log_status, dstport, protocol, action,
           count(*) AS n_rows, CAST(sum(bytes) AS BIGINT) AS bytes
    FROM flow GROUP BY log_status, dstport, protocol, action""",
)
def vpc_json_scan(spark: SparkSession, sf: str) -> DataFrame:
    flows = logs.read_vpc(spark, T.landed(spark, sf, "vpc"))
    return flows.groupBy("account_id", "interface_id", "log_status", "dstport", "protocol", "action").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("bytes").alias("bytes")
    )


@query(
    "malformed_records",
    """SELECT event_type, count(*) FILTER (WHERE k % 10 <> 9) AS n_good, count(*) FILTER (WHERE k % 10 = 9) AS n_bad
    FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY event_type""",
)
def malformed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every tenth k loses the end of its line; the scan keeps going."""
    path = scratch_path(spark, "broken")
    _broken_lines(spark, sf).write.text(path)
    files = logs.read_waf(spark, path, keep_corrupt=True)
    text = F.col("_corrupt_record")
    event_type = F.coalesce(
        F.substring("terminatingRule.ruleId", 3, 99), F.regexp_extract(text, '"ruleId":"r:([a-z]+)"', 1)
    )
    return files.groupBy(event_type.alias("event_type")).agg(
        F.count_if(text.isNull()).alias("n_good"), F.count_if(text.isNotNull()).alias("n_bad")
    )


@query(
    "unknown_fields",
    f"""WITH {T.LOG_SQL} SELECT 'h-' || uri AS hint, 'rule-' || (k % 3) AS note, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_changed
    FROM log GROUP BY ALL""",
)
def unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Fields outside the schema, by way of Parquet; records that don't come back whole."""
    path = scratch_path(spark, "unknown")
    request = F.col("httpRequest")
    told = request.withField("httpMethod", request["method"]).dropFields("method")
    at = F.timestamp_millis("timestamp")
    records = T.waf_logs(spark, sf).withColumns({
        "httpRequest": told.withField("hint", F.concat(F.lit("h-"), request["uri"])),
        "httpResponse": F.struct(F.lit(200).alias("status")),
        "note": F.struct(F.col("terminatingRule.ruleId").alias("rule"), F.array(F.lit(1.5)).alias("rates")),
        "dt": X.day_label(at),
        "hr": X.hour_label(at),
    })
    convert.write_partitioned(records, path + "/json", fmt="json")
    logs.read_waf(spark, path + "/json", keep_unknown=True).write.parquet(path + "/parquet")
    rows = spark.read.parquet(path + "/parquet")
    lines = spark.read.text(path + "/json").select(F.to_json(F.parse_json("value")).alias("line"), F.lit(1).alias("known"))
    # Lines begin alike, so sorting them compares long texts; their hashes go first.
    lines = lines.select(F.xxhash64("line").alias("hash"), "line", "known").distinct()
    rebuilt = rows.select(
        F.variant_get("unknown_fields", "$.httpRequest.hint", "string").alias("hint"),
        F.variant_get("unknown_fields", "$.note.rule", "string").alias("note"),
        F.to_json(logs.whole_record(rows)).alias("line"),
    )
    rebuilt = rebuilt.withColumn("hash", F.xxhash64("line"))
    changed = F.count_if(F.col("known").isNull()).alias("n_changed")
    return rebuilt.join(lines, ["hash", "line"], "left").groupBy("hint", "note").agg(F.count(F.lit(1)).alias("n_rows"), changed)


def _broken_lines(spark: SparkSession, sf: str) -> DataFrame:
    record = F.to_json(
        F.struct(
            F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
            F.struct(F.concat(F.lit("r:"), F.col("event_type")).alias("ruleId"), F.lit("ALLOW").alias("action")).alias(
                "terminatingRule"
            ),
        )
    )
    broken = F.from_json("props", "k INT")["k"] % 10 == 9
    line = F.when(broken, F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    return T.table(spark, sf, "events").withColumn("line", record).select(line.alias("value"))


# ---------------------------------------------------------------- hotspots


@query(
    "minute_counts",
    """SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS minute, event_type, count(*) AS value
    FROM events GROUP BY date_trunc('minute', ts), event_type""",
)
def minute_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = hotspots.count_groups(
        T.table(spark, sf, "events"), [X.minute_of(F.col("ts")).alias("minute"), "event_type"]
    )
    return counted.withColumn("minute", when_text("minute"))


@query(
    "hotspots_topk",
    f"""SELECT strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute, user_id, event_type, value FROM (
      SELECT date_trunc('minute', ts) AS minute, user_id, event_type, count(*) AS value FROM events GROUP BY ALL)
    ORDER BY value DESC, minute, user_id, event_type LIMIT {TOP_K}""",
)
def hotspots_topk(spark: SparkSession, sf: str) -> DataFrame:
    counted = hotspots.count_groups(
        T.table(spark, sf, "events"), [X.minute_of(F.col("ts")).alias("minute"), "user_id", "event_type"]
    )
    top = hotspots.top_by_value(counted, TOP_K, ["minute", "user_id", "event_type"])
    return top.withColumn("minute", when_text("minute"))


WAF_TOP_SQL = f"""SELECT date_trunc('minute', log_time) AS minute, ip AS key, uri AS subkey, country, label AS rule_label,
    count(*) AS value FROM log GROUP BY ALL
    ORDER BY value DESC, minute, key, subkey, country NULLS FIRST, rule_label NULLS FIRST LIMIT {TOP_K}"""


@query(
    "waf_hotspots",
    f"""WITH {T.LOG_SQL}, top AS ({WAF_TOP_SQL})
    SELECT * REPLACE (strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute), 'request_count' AS metric FROM top""",
)
def waf_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    top = hotspots.waf_hotspots(T.waf_logs(spark, sf), T.AS_OF, T.LOG_MINUTES, TOP_K)
    return top.withColumn("minute", when_text("minute"))


@query(
    "vpc_hotspots",
    f"""WITH {T.LOG_SQL}, flow AS ({FLOW_SQL})
    SELECT * FROM (
      SELECT strftime(date_trunc('minute', CAST(start_time AS TIMESTAMP)), '%Y-%m-%d %H:%M:%S') AS minute,
             srcaddr AS key, dstport AS subkey, protocol, action, count(*) AS value, 'connection_count' AS metric
      FROM flow GROUP BY ALL) ORDER BY value DESC, minute, key, subkey, protocol, action LIMIT {TOP_K}""",
)
def vpc_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    top = hotspots.vpc_hotspots(T.vpc_logs(spark, sf), T.AS_OF, T.LOG_MINUTES, TOP_K)
    return top.withColumn("minute", when_text("minute"))


@query(
    "union_hotspots",
    f"""WITH {T.LOG_SQL}, flow AS ({FLOW_SQL}), top AS ({WAF_TOP_SQL}), vpc AS (
      SELECT date_trunc('minute', CAST(start_time AS TIMESTAMP)) AS minute, srcaddr AS key, dstport AS port,
             count(*) AS value FROM flow GROUP BY ALL ORDER BY value DESC, minute, key, port LIMIT {TOP_K})
    SELECT strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute, key, subkey, country, rule_label, value,
           'request_count' AS metric, 'WAF' AS source_type FROM top
    UNION ALL
    SELECT strftime(minute, '%Y-%m-%d %H:%M:%S'), key, CAST(port AS VARCHAR), NULL, NULL, value,
           'connection_count', 'VPC' FROM vpc""",
)
def union_hotspots(spark: SparkSession, sf: str) -> DataFrame:
    both = hotspots.union_hotspots(
        T.waf_logs(spark, sf), T.vpc_logs(spark, sf), T.AS_OF, T.LOG_MINUTES, TOP_K
    )
    return both.withColumn("minute", when_text("minute"))


@query(
    "sliding_windows",
    """WITH starts AS (
      SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') - to_minutes(5 * i) AS window_start
      FROM events, generate_series(0, 2) AS g(i))
    SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS value
    FROM starts GROUP BY window_start, event_type""",
)
def sliding_windows(spark: SparkSession, sf: str) -> DataFrame:
    rows = windows.sliding_counts(T.table(spark, sf, "events"), F.col("ts").cast("timestamp"), ["event_type"], 15, 5)
    return rows.withColumn("window_start", when_text("window_start"))


# ---------------------------------------------------------------- scalars


@query(
    "numeric_coerce",
    """SELECT page_id, coalesce(try_cast(regexp_extract(url, '([^/]*)$', 1) AS DOUBLE), 0.0) AS value FROM pages""",
)
def numeric_coerce(spark: SparkSession, sf: str) -> DataFrame:
    tail = F.regexp_extract("url", "([^/]*)$", 1)
    return T.table(spark, sf, "pages").select("page_id", X.number_or_zero(tail).alias("value"))


@query(
    "feature_key",
    """SELECT c_custkey, coalesce(c_name, '') || '|' || coalesce(n_name, '') || '|'
           || coalesce(CASE WHEN c_acctbal >= 0 THEN c_mktsegment END, '') AS feature_key
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def feature_key(spark: SparkSession, sf: str) -> DataFrame:
    nation = T.table(spark, sf, "nation")
    rows = T.table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    agent = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return rows.select("c_custkey", X.feature_key([F.col("c_name"), F.col("n_name"), agent]).alias("feature_key"))


@query(
    "latest_point",
    """SELECT metric, key, subkey, strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute, round(value, 6) AS value FROM (
      SELECT 'value' AS metric, CAST(user_id AS VARCHAR) AS key, event_type AS subkey,
             date_trunc('minute', ts) AS minute, sum(value) AS value,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('minute', ts) DESC) AS rn
      FROM events GROUP BY user_id, event_type, date_trunc('minute', ts)) WHERE rn = 1""",
)
def latest_point(spark: SparkSession, sf: str) -> DataFrame:
    points = series.to_points(
        T.table(spark, sf, "events").select(
            F.lit("value").alias("metric"),
            F.col("user_id").alias("key"),
            F.col("event_type").alias("subkey"),
            X.minute_of(F.col("ts")).alias("minute"),
            "value",
        )
    )
    return series.latest_point(points).withColumns({"minute": when_text("minute"), "value": rounded("value")})


# ---------------------------------------------------------------- smoothing

ALPHA = 0.3
MONTH, DAY = 31 * 24 * 60, 24 * 60
DAILY = DetectionParams(alpha=ALPHA, lookback_minutes=MONTH, step_minutes=DAY)


def folded_sql(points: str, alpha: float = ALPHA, ties: str = "value DESC", extra: str = "", lead: str = "") -> str:
    """CTE ``f``: every point with the state before (p*) and after it."""
    keep = 1 - alpha
    carried = "".join(f", {c}" for c in extra.split(",") if c)
    p_carried = "".join(f", p.{c.strip()}" for c in extra.split(",") if c)
    return f"""WITH RECURSIVE {lead} p AS (
      SELECT *, row_number() OVER (PARTITION BY metric, key, subkey ORDER BY minute, {ties}) AS rn FROM ({points})),
    f AS (
      SELECT metric, key, subkey, minute, value, rn{carried}, value AS m, CAST(0 AS DOUBLE) AS c, CAST(1 AS DOUBLE) AS q,
             CAST(NULL AS DOUBLE) AS pm, CAST(NULL AS DOUBLE) AS pstd FROM p WHERE rn = 1
      UNION ALL
      SELECT p.metric, p.key, p.subkey, p.minute, p.value, p.rn{p_carried}, f.m + {alpha} * (p.value - f.m),
             {keep} * (f.c + {alpha} * (p.value - f.m) * (p.value - f.m)), {keep * keep} * f.q + {alpha * alpha},
             f.m, CASE WHEN f.rn >= 2 THEN sqrt(f.c / (1 - f.q)) END
      FROM f JOIN p ON p.metric = f.metric AND p.key = f.key AND p.subkey = f.subkey AND p.rn = f.rn + 1),
    s AS (SELECT *, CASE WHEN rn >= 2 THEN sqrt(c / (1 - q)) END AS std FROM f)"""


TEXT_MINUTE = "strftime(minute, '%Y-%m-%d %H:%M:%S') AS minute"


@query(
    "ewma_mean",
    f"{folded_sql(T.DAILY_SQL)} SELECT metric, key, subkey, {TEXT_MINUTE}, value, round(m, 6) AS ewma FROM s",
)
def ewma_mean(spark: SparkSession, sf: str) -> DataFrame:
    points = series.to_points(T.daily_by_user(spark, sf))
    rows = series.smoothed(points, ALPHA, DAILY.block_minutes)
    return rows.select(*KEYS, when_text("minute"), "value", rounded("ewma"))


@query(
    "ewma_std",
    f"{folded_sql(T.HOURLY_SQL)} SELECT metric, key, subkey, {TEXT_MINUTE}, round(std, 6) AS ewma_std FROM s",
)
def ewma_std(spark: SparkSession, sf: str) -> DataFrame:
    points = series.to_points(T.hourly_by_type(spark, sf))
    rows = series.smoothed(points, ALPHA, DetectionParams().block_minutes)
    return rows.select(*KEYS, when_text("minute"), rounded("ewma_std"))


@query(
    "zscore",
    """SELECT event_id, round(CASE WHEN std = 0 THEN 0 ELSE (value - mean) / std END, 6) AS score
    FROM events JOIN (SELECT event_type, avg(value) AS mean, stddev_samp(value) AS std FROM events GROUP BY event_type)
    USING (event_type)""",
)
def zscore_query(spark: SparkSession, sf: str) -> DataFrame:
    events = T.table(spark, sf, "events")
    path = scratch_path(spark, "types")
    per_type = events.groupBy("event_type").agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
    per_type.write.parquet(path)
    saved = spark.read.schema(per_type.schema).parquet(path)
    size = saved.agg(F.sum(64 + F.octet_length("event_type"))).first()[0] or 0
    scored = events.join(broadcast_within(saved, 1, size), "event_type").withColumn(
        "score", zscore(F.col("value"), F.col("mean"), F.col("std"))
    )
    return scored.select("event_id", rounded("score"))


LAST_SQL = "QUALIFY row_number() OVER (PARTITION BY metric, key, subkey ORDER BY rn DESC) = 1"


@query(
    "baseline_train",
    f"""{folded_sql(T.DAILY_SQL)} SELECT metric, key, subkey, round(m, 6) AS mean, round(coalesce(std, 0), 6) AS std,
    {TEXT_MINUTE.replace('AS minute', 'AS last_minute')} FROM s {LAST_SQL}""",
)
def baseline_train(spark: SparkSession, sf: str) -> DataFrame:
    trained = scoring.train_baselines(T.daily_by_user(spark, sf), DAILY)
    return trained.select(*KEYS, rounded("mean"), rounded("std"), when_text("last_minute"))


@query(
    "baseline_train_days",
    f"""{folded_sql(f"SELECT * FROM ({T.HOURLY_SQL}) WHERE minute >= TIMESTAMP '2024-01-23 23:57:12' AND minute <= {UNTIL}")}
    SELECT metric, key, subkey, round(m, 6) AS mean, round(coalesce(std, 0), 6) AS std FROM s {LAST_SQL}""",
)
def baseline_train_days(spark: SparkSession, sf: str) -> DataFrame:
    trained = scoring.train_baselines(T.hourly_by_type(spark, sf), DetectionParams(alpha=ALPHA), as_of=LAST_EVENT)
    return trained.select(*KEYS, rounded("mean"), rounded("std"))


SPLIT = "TIMESTAMP '2024-01-04'"
BEFORE_SQL = folded_sql(f"SELECT * FROM ({T.DAILY_SQL}) WHERE minute < {SPLIT}")
AFTER_SQL = folded_sql(f"SELECT * FROM ({T.DAILY_SQL}) WHERE minute >= {SPLIT}")


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    daily, split = T.daily_by_user(spark, sf), F.lit("2024-01-04 00:00:00").cast("timestamp")
    return daily.where(F.col("minute") < split), daily.where(F.col("minute") >= split)


@query(
    "baseline_load_or_train",
    f"""WITH old AS ({BEFORE_SQL} SELECT * FROM s {LAST_SQL}), new AS ({AFTER_SQL} SELECT * FROM s {LAST_SQL})
    SELECT new.metric, new.key, new.subkey, round(coalesce(old.m, new.m), 6) AS mean,
           round(CASE WHEN old.m IS NOT NULL THEN coalesce(old.std, 0) ELSE coalesce(new.std, 0) END, 6) AS std,
           old.m IS NULL AS trained
    FROM new LEFT JOIN old ON old.metric = new.metric AND old.key = new.key AND old.subkey = new.subkey""",
)
def baseline_load_or_train(spark: SparkSession, sf: str) -> DataFrame:
    params = DAILY
    before, after = _halves(spark, sf)
    both = scoring.load_or_train(after, scoring.train_baselines(before, params), params)
    return both.select(*KEYS, rounded("mean"), rounded("std"), "trained")


UPSERT_SQL = f"""WITH old AS ({BEFORE_SQL} SELECT * FROM s {LAST_SQL}), new AS ({AFTER_SQL} SELECT * FROM s {LAST_SQL})
    SELECT coalesce(new.metric, old.metric) AS metric, coalesce(new.key, old.key) AS key,
           coalesce(new.subkey, old.subkey) AS subkey,
           round(CASE WHEN new.m IS NOT NULL THEN new.m ELSE old.m END, 6) AS mean,
           round(coalesce(CASE WHEN new.m IS NOT NULL THEN new.std ELSE old.std END, 0), 6) AS std
    FROM new FULL JOIN old ON old.metric = new.metric AND old.key = new.key AND old.subkey = new.subkey"""


@query("baseline_upsert", UPSERT_SQL)
def baseline_upsert(spark: SparkSession, sf: str) -> DataFrame:
    params = DAILY
    before, after = (scoring.train_baselines(half, params) for half in _halves(spark, sf))
    return upsert(before, after).select(*KEYS, rounded("mean"), rounded("std"))


@query("baseline_store", UPSERT_SQL)
def baseline_store(spark: SparkSession, sf: str) -> DataFrame:
    """Two saved runs, compacted after the first, read back as one."""
    params = DAILY
    before, after = (scoring.train_baselines(half, params) for half in _halves(spark, sf))
    store = BaselineStore(spark, scratch_path(spark, "baselines"))
    store.append(before, "run-1")
    store.compact()
    store.append(after, "run-2")
    return store.load().select(*KEYS, rounded("mean"), rounded("std"))


@query(
    "baseline_bucketed",
    f"""SELECT * FROM ({UPSERT_SQL}) WHERE (key, subkey) IN
    (SELECT (CAST(user_id AS VARCHAR), event_type) FROM events WHERE ts < TIMESTAMP '2024-01-02 00:00:00')""",
)
def baseline_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs of a bucketed store, the first compacted; series of the first day."""
    before, after = (scoring.train_baselines(half, DAILY) for half in _halves(spark, sf))
    store = BaselineStore(spark, scratch_path(spark, "bucketed"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    store.append(before, "001")
    store.compact()
    store.append(after, "002")
    first_day = T.daily_by_user(spark, sf).where(F.col("minute") < F.lit("2024-01-02 00:00:00").cast("timestamp"))
    rows = newest_per_series(of_active_series(store.history(), first_day))
    return rows.select(*KEYS, rounded("mean"), rounded("std"))


# ---------------------------------------------------------------- detection

HOURLY = DetectionParams(
    alpha=ALPHA, sigma=3.0, min_count=5, scope="all", lookback_minutes=MONTH, step_minutes=60, top_k=20
)

PRIOR_SQL = f"""{folded_sql(T.HOURLY_SQL)}, scored AS (
      SELECT *, CASE WHEN rn > 5 THEN CASE WHEN pstd = 0 THEN 0 ELSE (value - pm) / pstd END END AS score FROM s),
    found AS (SELECT metric, key, subkey, minute, value, score, pm AS baseline_mean, pstd AS baseline_std,
      CASE WHEN score > 0 THEN 'high' ELSE 'low' END AS mode FROM scored WHERE abs(score) > 3.0),
    top AS (SELECT *, row_number() OVER (ORDER BY abs(score) DESC, metric, key, subkey, minute) AS place FROM found)"""
FOUND_COLUMNS = f"""metric, key, subkey, {TEXT_MINUTE}, value, round(score, 6) AS score,
    round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std, mode"""


def _found(findings: DataFrame) -> DataFrame:
    return findings.select(
        *KEYS, when_text("minute"), "value", rounded("score"), rounded("baseline_mean"), rounded("baseline_std"), "mode"
    )


@query("detect_prior", f"{PRIOR_SQL} SELECT {FOUND_COLUMNS} FROM found")
def detect_prior(spark: SparkSession, sf: str) -> DataFrame:
    return _found(scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY, top_k=None).findings)


@query("topk_anomalies", f"{PRIOR_SQL} SELECT {FOUND_COLUMNS} FROM top WHERE place <= 20")
def topk_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return _found(scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY).findings)


@query(
    "detect_last_prior",
    f"""{folded_sql(T.DAILY_SQL)}, newest AS (SELECT * FROM s {LAST_SQL}), scored AS (
      SELECT *, CASE WHEN rn > 5 THEN CASE WHEN pstd = 0 THEN 0 ELSE (value - pm) / pstd END END AS score FROM newest),
    found AS (SELECT metric, key, subkey, minute, value, score, pm AS baseline_mean, pstd AS baseline_std,
      CASE WHEN score > 0 THEN 'high' ELSE 'low' END AS mode FROM scored WHERE abs(score) > 1.0)
    SELECT {FOUND_COLUMNS} FROM found""",
)
def detect_last_prior(spark: SparkSession, sf: str) -> DataFrame:
    params = HOURLY.with_(scope="last", sigma=1.0, step_minutes=DAY)
    return _found(scoring.detect_anomalies(T.daily_by_user(spark, sf), params, top_k=None).findings)


UPDATED_SQL = """updated AS (
      SELECT *, greatest(sqrt(0.7 * bs * bs + 0.3 * (value - um) * (value - um)), 1e-6) AS us
      FROM (SELECT *, 0.7 * bm + 0.3 * value AS um FROM base)),
    found AS (SELECT metric, key, subkey, minute, value, (value - um) / us AS score, um AS baseline_mean,
      us AS baseline_std, CASE WHEN value > um THEN 'high' ELSE 'low' END AS mode FROM updated)"""


@query(
    "detect_post_update",
    f"""{folded_sql(T.DAILY_SQL)}, base AS (SELECT *, m AS bm, coalesce(std, 0) AS bs FROM s {LAST_SQL}), {UPDATED_SQL}
    SELECT {FOUND_COLUMNS} FROM found WHERE abs(score) > 0.9""",
)
def detect_post_update(spark: SparkSession, sf: str) -> DataFrame:
    params = DAILY.with_(sigma=0.9, mode="post_update")
    return _found(scoring.detect_anomalies(T.daily_by_user(spark, sf), params, top_k=None).findings)


@query(
    "detect_with_stored",
    f"""WITH old AS ({BEFORE_SQL} SELECT * FROM s {LAST_SQL}), new AS ({AFTER_SQL} SELECT * FROM s {LAST_SQL}),
    base AS (SELECT new.metric, new.key, new.subkey, new.minute, new.value, coalesce(old.m, new.m) AS bm,
        CASE WHEN old.m IS NOT NULL THEN coalesce(old.std, 0) ELSE coalesce(new.std, 0) END AS bs
      FROM new LEFT JOIN old ON old.metric = new.metric AND old.key = new.key AND old.subkey = new.subkey),
    {UPDATED_SQL} SELECT {FOUND_COLUMNS} FROM found WHERE abs(score) > 1.0""",
)
def detect_with_stored(spark: SparkSession, sf: str) -> DataFrame:
    """All points are given; those a stored baseline has seen are skipped."""
    params = DAILY.with_(sigma=1.0, mode="post_update")
    before, _ = _halves(spark, sf)
    stored = scoring.train_baselines(before, params)
    return _found(scoring.detect_anomalies(T.daily_by_user(spark, sf), params, stored, top_k=None).findings)


@query(
    "detect_resumed",
    f"""{PRIOR_SQL} SELECT {FOUND_COLUMNS} FROM found WHERE minute >= TIMESTAMP '2024-01-16'""",
)
def detect_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A fold resumed from saved state finds what one unbroken fold finds."""
    hourly, split = T.hourly_by_type(spark, sf), F.lit("2024-01-16 00:00:00").cast("timestamp")
    blocks = HOURLY.with_(block_points=100)
    stored = scoring.train_baselines(hourly.where(F.col("minute") < split), blocks)
    later = hourly.where(F.col("minute") >= split)
    return _found(scoring.detect_anomalies(later, blocks, stored, top_k=None).findings)


SILENT = DAILY.with_(silence="zero", scope="all", sigma=2.0, min_count=2, top_k=None)
DENSE_SQL = f"""SELECT d.metric, d.key, d.subkey, d.minute, coalesce(p.value, 0) AS value,
      p.value IS NOT NULL OR d.minute = TIMESTAMP '2024-01-30' AS seen
    FROM (SELECT metric, key, subkey, unnest(generate_series(min(minute), TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS minute
      FROM ({T.DAILY_SQL}) GROUP BY metric, key, subkey) d
    LEFT JOIN ({T.DAILY_SQL}) p ON p.key = d.key AND p.subkey = d.subkey AND p.minute = d.minute"""


@query(
    "detect_silent",
    f"""{folded_sql(DENSE_SQL, extra="seen")}, scored AS (
      SELECT *, pm AS baseline_mean, pstd AS baseline_std,
        CASE WHEN rn > 2 THEN CASE WHEN pstd = 0 THEN 0 ELSE (value - pm) / pstd END END AS score FROM s)
    SELECT {FOUND_COLUMNS} FROM (SELECT *, CASE WHEN score > 0 THEN 'high' ELSE 'low' END AS mode FROM scored) WHERE seen AND abs(score) > 2.0""",
)
def detect_silent(spark: SparkSession, sf: str) -> DataFrame:
    """Days without events count as 0, and the last day of every user and type is scored."""
    last = dt.datetime(2024, 1, 30, tzinfo=dt.timezone.utc)
    return _found(scoring.detect_anomalies(T.daily_by_user(spark, sf), SILENT, until=last).findings)


@query(
    "detect_flat",
    f"""{folded_sql(T.DAILY_SQL)}, scored AS (
      SELECT *, pm AS baseline_mean, pstd AS baseline_std,
        CASE WHEN rn > 2 THEN CASE WHEN pstd = 0 THEN (value - pm) / 1e-6 ELSE (value - pm) / pstd END END AS score FROM s)
    SELECT {FOUND_COLUMNS} FROM (SELECT *, CASE WHEN score > 0 THEN 'high' ELSE 'low' END AS mode FROM scored) WHERE abs(score) > 3.0""",
)
def detect_flat(spark: SparkSession, sf: str) -> DataFrame:
    """Any deviation from a series that was the same on all days before."""
    params = DAILY.with_(flag_flat=True, scope="all", min_count=2, top_k=None)
    return _found(scoring.detect_anomalies(T.daily_by_user(spark, sf), params).findings)


# Hourly counts of each type against its own mean and deviation; a step is in deviations.
CHANGES = changes.ChangeParams(drift=0.25, limit=2.0, block_minutes=7 * 24 * 60)


@query(
    "cusum_alarms",
    f"""WITH RECURSIVE p AS ({T.HOURLY_SQL}),
    z AS (SELECT *, (value - avg(value) OVER k) / stddev_samp(value) OVER k AS z, row_number() OVER (PARTITION BY key ORDER BY minute) AS rn
      FROM p WINDOW k AS (PARTITION BY key)),
    sums AS (
      SELECT metric, key, subkey, minute, value, rn, z - 0.25 AS r_up, -z - 0.25 AS r_down FROM z WHERE rn = 1
      UNION ALL
      SELECT z.metric, z.key, z.subkey, z.minute, z.value, z.rn,
        CASE WHEN r_up > 2 THEN 0 ELSE greatest(0, r_up) END + z.z - 0.25, CASE WHEN r_down > 2 THEN 0 ELSE greatest(0, r_down) END - z.z - 0.25
      FROM sums JOIN z ON z.key = sums.key AND z.rn = sums.rn + 1)
    SELECT metric, key, subkey, {TEXT_MINUTE}, value,
      CASE WHEN r_up > 2 AND r_down > 2 THEN 'both' WHEN r_up > 2 THEN 'up' ELSE 'down' END AS alarm,
      round(greatest(r_up, r_down), 6) AS reached FROM sums WHERE r_up > 2 OR r_down > 2""",
)
def cusum_alarms(spark: SparkSession, sf: str) -> DataFrame:
    found = changes.change_alarms(T.hourly_by_type(spark, sf), CHANGES)
    return found.select(*KEYS, when_text("minute"), "value", "alarm", rounded("reached"))


@query(
    "run_summary",
    f"""{PRIOR_SQL} SELECT count(*) AS anomaly_count, round(coalesce(max(abs(score)), 0), 6) AS max_anomaly_score
    FROM found""",
)
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY, top_k=None).findings
    return scoring.run_summary(found).select("anomaly_count", rounded("max_anomaly_score"))


# ---------------------------------------------------------------- alerts


@query(
    "metric_record",
    f"""{PRIOR_SQL} SELECT 'LogAnomalies' AS namespace, 'Detector' AS dimension, 'hourly' AS detector,
    CAST(1706659200000 AS BIGINT) AS timestamp_ms, count(*) AS anomaly_count,
    round(coalesce(max(abs(score)), 0), 6) AS max_anomaly_score FROM found""",
)
def metric_record(spark: SparkSession, sf: str) -> DataFrame:
    found = scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY, top_k=None).findings
    record = alerts.metric_record(found, "LogAnomalies", {"Detector": "hourly"}, 1706659200000)
    at = lambda path: F.get_json_object("record", path)
    return record.select(
        at("$._aws.CloudWatchMetrics[0].Namespace").alias("namespace"),
        at("$._aws.CloudWatchMetrics[0].Dimensions[0][0]").alias("dimension"),
        at("$.Detector").alias("detector"),
        at("$._aws.Timestamp").cast("bigint").alias("timestamp_ms"),
        at("$.AnomalyCount").cast("bigint").alias("anomaly_count"),
        F.round(at("$.MaxAnomalyScore").cast("double"), 6).alias("max_anomaly_score"),
    )


TEXT_SQL = """'*' || place || '. Metric:* `' || metric || '`' || chr(10) || '*Key:* `' || key || '`' || chr(10)
    || '*Subkey:* `' || subkey || '`' || chr(10) || '*Value:* `' || CAST(value AS BIGINT) || '`' || chr(10)
    || '*Score (Sigma):* `' || printf('%.2f', score) || '` (' || mode || ')' || chr(10)
    || '*Baseline Mean:* `' || printf('%.2f', baseline_mean) || '`' || chr(10)
    || '*Baseline StdDev:* `' || printf('%.2f', baseline_std) || '`' || chr(10)"""


@query(
    "alert_rows",
    f"""{PRIOR_SQL} SELECT CAST(place AS INTEGER) AS rank, {TEXT_SQL} AS text, CAST(NULL AS VARCHAR) AS ioc_text
    FROM top WHERE place <= 20""",
)
def alert_rows(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.alert_rows(scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY).findings, HOURLY.top_k)


@query(
    "chat_digest",
    f"""{PRIOR_SQL}, body AS (SELECT {TEXT_SQL} AS text, place FROM top WHERE place <= 20)
    SELECT CAST(3 + 2 * count(*) AS INTEGER) AS n_blocks, '🚨 Log anomaly detected (' || count(*) || ' findings) 🚨' AS header,
           '*Detection Time:* 2024-01-31' || chr(10) || '*Source:* hourly' AS source,
           max(CASE WHEN place = 1 THEN text END) AS first_text, max(CASE WHEN place = 20 THEN text END) AS last_text
    FROM body""",
)
def chat_digest(spark: SparkSession, sf: str) -> DataFrame:
    found = scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY).findings
    message = alerts.chat_digest(found, {"timestamp": "2024-01-31", "source": "hourly"}, HOURLY.top_k)
    block = "STRUCT<type: STRING, text: STRUCT<type: STRING, text: STRING>>"
    blocks = F.from_json("message", f"blocks ARRAY<{block}>")["blocks"]
    text_at = lambda i: F.get("b", F.lit(i))["text"]["text"]
    return message.select(blocks.alias("b")).select(
        F.size("b").alias("n_blocks"),
        text_at(0).alias("header"),
        text_at(1).alias("source"),
        text_at(3).alias("first_text"),
        text_at(41).alias("last_text"),
    )


@query(
    "alert_document",
    f"""{PRIOR_SQL} SELECT 'Log anomaly detected (' || (SELECT count(*) FROM top WHERE place <= 20) || ' findings)' AS subject,
    'hourly' AS source, CAST(place AS INTEGER) AS rank, key, value, round(score, 6) AS score, mode FROM top WHERE place <= 20""",
)
def alert_document(spark: SparkSession, sf: str) -> DataFrame:
    found = scoring.detect_anomalies(T.hourly_by_type(spark, sf), HOURLY).findings
    document = alerts.alert_document(found, {"source": "hourly"}, "2024-01-31T00:00:00Z", HOURLY.top_k)
    layout = (
        "subject STRING, findings ARRAY<STRUCT<key: STRING, value: DOUBLE, score: DOUBLE, mode: STRING>>,"
        " context STRUCT<source: STRING>"
    )
    parsed = document.select(F.from_json("message", layout).alias("d"))
    rows = parsed.select("d.subject", F.col("d.context.source").alias("source"), F.posexplode("d.findings"))
    return rows.select(
        "subject", "source", (F.col("pos") + 1).alias("rank"), "col.key", "col.value",
        F.round("col.score", 6).alias("score"), "col.mode",
    )


# ---------------------------------------------------------------- indicators

LOG_CONFIG = {
    "cidrs": ["192.168.0.0/16", "10.0.0.100/32", "10.0.0.98/31", "2001:db8::/32"],
    "country": ["KP", "RU"],
    "ua": ["masscan", "ZGrab"],
    "uri": ["/.env", "/purchase"],
    "regex": {"ua": ["(?i)sqlmap", "(?i)curl|wget"], "uri": ["/etc/passwd", "(?i)UNION.*SELECT"]},
}
LOG_INDICATORS = Indicators.from_config(LOG_CONFIG)
# JSON is YAML as well.
LOG_INDICATORS_YAML = json.dumps(LOG_CONFIG)
CIDR_SQL = """CASE WHEN ip = '10.0.0.100' THEN 'CIDR:10.0.0.100/32'
    WHEN CAST(split_part(ip, '.', 4) AS INTEGER) BETWEEN 98 AND 99 THEN 'CIDR:10.0.0.98/31' END"""
COUNTRY_SQL = "CASE WHEN country IN ('KP', 'RU') THEN 'Country:' || country END"
UA_SQL = "CASE WHEN ua IN ('masscan', 'ZGrab') THEN 'UA_Exact:' || ua END"
UA_REGEX_SQL = """CASE WHEN regexp_matches(ua, 'sqlmap', 'i') THEN 'UA_Regex:(?i)sqlmap'
    WHEN regexp_matches(ua, 'curl|wget', 'i') THEN 'UA_Regex:(?i)curl|wget' END"""
URI_SQL = "CASE WHEN uri IN ('/.env', '/purchase') THEN 'URI_Exact:' || uri END"
URI_REGEX_SQL = """CASE WHEN regexp_matches(uri, '/etc/passwd', 'i') THEN 'URI_Regex:/etc/passwd'
    WHEN regexp_matches(uri, 'UNION.*SELECT', 'i') THEN 'URI_Regex:(?i)UNION.*SELECT' END"""
RULES_SQL = f"""list_filter([{CIDR_SQL}, {COUNTRY_SQL}, {UA_SQL}, {UA_REGEX_SQL}, {URI_SQL}, {URI_REGEX_SQL}],
    lambda x: x IS NOT NULL)"""


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    return slices.slice_waf(T.waf_logs(spark, sf), T.AS_OF, T.LOG_MINUTES).select(
        when_text("event_time"), "client_ip", "country", "user_agent", "uri"
    )


REQUEST_SQL = "strftime(log_time, '%Y-%m-%d %H:%M:%S') AS event_time, ip AS client_ip, country, ua AS user_agent, uri"


@query("ioc_exact", f"WITH {T.LOG_SQL} SELECT {REQUEST_SQL}, {UA_SQL} AS ua_rule, {URI_SQL} AS uri_rule FROM log")
def ioc_exact(spark: SparkSession, sf: str) -> DataFrame:
    rows = indicators.match_user_agent(_requests(spark, sf), "user_agent", LOG_INDICATORS)
    return indicators.match_uri(rows, "uri", LOG_INDICATORS).drop("ua_regex_rule", "uri_regex_rule")


@query(
    "ioc_uri_list",
    """SELECT page_id, CASE WHEN url IN (SELECT url FROM pages WHERE length(html) > 2000) THEN 'URI_Exact:' || url END
    AS uri_rule FROM pages""",
)
def ioc_uri_list(spark: SparkSession, sf: str) -> DataFrame:
    """The addresses of long pages as a list, which is too long for literals: a join."""
    pages = T.table(spark, sf, "pages")
    return indicators.match_uri_table(pages, "url", pages.where(F.length("html") > 2000).select("url")).select(
        "page_id", "uri_rule"
    )


@query(
    "ioc_load",
    f"WITH {T.LOG_SQL}, r AS (SELECT *, {RULES_SQL} AS rules FROM log) SELECT {REQUEST_SQL}, array_to_string(rules, ' & ') AS rules FROM r",
)
def ioc_load(spark: SparkSession, sf: str) -> DataFrame:
    """Indicators from a file in the shared folder, read through its file system."""
    path = scratch_path(spark, "indicators")
    spark.createDataFrame([(LOG_INDICATORS_YAML,)], "value string").write.text(path)
    rows = indicators.match_all(_requests(spark, sf), load_indicators(path, spark))
    return rows.withColumn("rules", F.array_join("rules", " & ")).drop("matched")


@query("ioc_country", f"WITH {T.LOG_SQL} SELECT {REQUEST_SQL}, {COUNTRY_SQL} AS country_rule FROM log")
def ioc_country(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.match_country(_requests(spark, sf), "country", LOG_INDICATORS)


@query(
    "ioc_regex",
    """SELECT page_id, CASE WHEN regexp_matches(url, 'PAGE=2', 'i') THEN 'URI_Regex:PAGE=2'
    WHEN regexp_matches(url, '/en/', 'i') THEN 'URI_Regex:/en/' END AS uri_regex_rule FROM pages""",
)
def ioc_regex(spark: SparkSession, sf: str) -> DataFrame:
    patterns = Indicators.from_config({"regex": {"uri": ["PAGE=2", "/en/"]}})
    return indicators.match_uri(T.table(spark, sf, "pages"), "url", patterns).select("page_id", "uri_regex_rule")


@query(
    "ioc_ua_regex",
    f"WITH {T.LOG_SQL} SELECT {REQUEST_SQL}, {UA_REGEX_SQL} AS ua_regex_rule FROM log",
)
def ioc_ua_regex(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.match_user_agent(_requests(spark, sf), "user_agent", LOG_INDICATORS).drop("ua_rule")


IP_TEXT = r"\b[0-9]{1,3}(?:\.[0-9]{1,3}){3}\b"
TEXT_NETS = ["161.17.0.0/16", "96.0.0.0/3", "128.0.0.0/2", "96.153.0.0/16", "108.0.0.0/6", "0.0.0.0/2"]


@query(
    "ioc_cidr",
    f"""WITH found AS (SELECT doc_id, unnest(regexp_extract_all(text, '{IP_TEXT}')) AS ip FROM documents),
    octets AS (SELECT doc_id, ip, CAST(split_part(ip, '.', 1) AS INTEGER) AS a, CAST(split_part(ip, '.', 2) AS INTEGER) AS b,
      CAST(split_part(ip, '.', 3) AS INTEGER) AS c, CAST(split_part(ip, '.', 4) AS INTEGER) AS d FROM found)
    SELECT doc_id, ip, CASE WHEN greatest(a, b, c, d) > 255 OR regexp_matches(ip, '(^|\\.)0[0-9]') THEN NULL
      WHEN a = 161 AND b = 17 THEN 'CIDR:161.17.0.0/16' WHEN a BETWEEN 96 AND 127 THEN 'CIDR:96.0.0.0/3'
      WHEN a BETWEEN 128 AND 191 THEN 'CIDR:128.0.0.0/2' WHEN a < 64 THEN 'CIDR:0.0.0.0/2' END AS cidr_rule FROM octets""",
)
def ioc_cidr(spark: SparkSession, sf: str) -> DataFrame:
    found = T.table(spark, sf, "documents").select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(IP_TEXT), 0)).alias("ip")
    )
    return indicators.match_cidr(found, "ip", Indicators.from_config({"cidrs": TEXT_NETS}))


V6_NETS = ["2001:db8:10::/44", "2001:db8::/40", "2001:db8:100::/40", "10.0.0.0/8", "::/0"]


@query(
    "ioc_cidr_v6",
    """SELECT event_id, CASE WHEN user_id % 1024 BETWEEN 16 AND 31 THEN 'CIDR:2001:db8:10::/44'
      WHEN user_id % 1024 < 256 THEN 'CIDR:2001:db8::/40' WHEN user_id % 1024 < 512 THEN 'CIDR:2001:db8:100::/40'
      ELSE 'CIDR:::/0' END AS cidr_rule FROM events""",
)
def ioc_cidr_v6(spark: SparkSession, sf: str) -> DataFrame:
    site, host = F.hex(F.col("user_id") % 1024), F.hex(F.col("event_id") % 65536)
    address = F.concat(F.lit("2001:DB8:"), site, F.lit("::"), host)
    rows = T.table(spark, sf, "events").select("event_id", address.alias("ip"))
    return indicators.match_cidr(rows, "ip", Indicators.from_config({"cidrs": V6_NETS})).drop("ip")


# Two thousand page numbers as patterns, few of which a page's address can match.
PAGE_PATTERNS = [f"/(?:en|fr)/{n}(?:[/?#]|$)" for n in range(0, 2000)] + ["ref=[a-f]$"]


@query(
    "ioc_many_patterns",
    """SELECT page_id, url, CASE
      WHEN regexp_matches(url, '/(en|fr)/(0|[1-9][0-9]{0,2}|1[0-9]{3})([/?#]|$)', 'i')
      THEN 'URI_Regex:/(?:en|fr)/' || regexp_extract(url, '/(en|fr)/(0|[1-9][0-9]{0,2}|1[0-9]{3})([/?#]|$)', 2, 'i') || '(?:[/?#]|$)'
      WHEN regexp_matches(url, 'ref=[a-f]$', 'i') THEN 'URI_Regex:ref=[a-f]$' END AS uri_regex_rule FROM pages""",
)
def ioc_many_patterns(spark: SparkSession, sf: str) -> DataFrame:
    found = Indicators.from_config({"regex": {"uri": PAGE_PATTERNS}})
    return indicators.match_uri(T.table(spark, sf, "pages").select("page_id", "url"), "url", found).drop("uri_rule")


AS_CONFIG = {"asn": ["AS64515", "AS64580", "AS64600"]}
AS_RANGES_SQL = """SELECT p_partkey * 20000 AS first, p_partkey * 20000 + 19999 - p_partkey % 7 * 1000 AS last,
    'AS' || (64512 + p_partkey % 97) AS asn FROM part"""


@query(
    "ioc_asn",
    f"""WITH r AS ({AS_RANGES_SQL}), e AS (SELECT event_id, event_id * 2654435761 % 67108864 AS n FROM events)
    SELECT event_id, (n // 16777216) || '.' || (n // 65536 % 256) || '.' || (n // 256 % 256) || '.' || (n % 256) AS ip, asn,
      CASE WHEN asn IN ('AS64515', 'AS64580', 'AS64600') THEN 'ASN:' || asn END AS asn_rule
    FROM e LEFT JOIN r ON n BETWEEN first AND last""",
)
def ioc_asn(spark: SparkSession, sf: str) -> DataFrame:
    """The autonomous system of every event's address, and the listed ones among them."""
    part = F.col("p_partkey")
    ranges = T.table(spark, sf, "part").select(
        (part * 20000).alias("first"),
        (part * 20000 + 19999 - part % 7 * 1000).alias("last"),
        F.concat(F.lit("AS"), (part % 97 + 64512).cast("string")).alias("asn"),
    )
    n = F.expr("event_id * 2654435761 % 67108864")
    octets = [F.shiftright(n, 24), F.shiftright(n, 16) % 256, F.shiftright(n, 8) % 256, n % 256]
    rows = T.table(spark, sf, "events").select("event_id", F.concat_ws(".", *[o.cast("string") for o in octets]).alias("ip"))
    return indicators.match_asn(indicators.with_asn(rows, "ip", ranges), "asn", Indicators.from_config(AS_CONFIG))


@query(
    "ioc_combined",
    f"""WITH {T.LOG_SQL}, r AS (SELECT *, {RULES_SQL} AS rules FROM log)
    SELECT {REQUEST_SQL}, len(rules) > 0 AS matched, array_to_string(rules, ' & ') AS rules FROM r""",
)
def ioc_combined(spark: SparkSession, sf: str) -> DataFrame:
    rows = indicators.match_all(_requests(spark, sf), LOG_INDICATORS)
    return rows.withColumn("rules", F.array_join("rules", " & "))


@query(
    "ioc_semi",
    f"WITH {T.LOG_SQL}, r AS (SELECT *, {RULES_SQL} AS rules FROM log) SELECT {REQUEST_SQL} FROM r WHERE len(rules) > 0",
)
def ioc_semi(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.keep_matched(_requests(spark, sf), LOG_INDICATORS)


@query(
    "ioc_anti",
    f"WITH {T.LOG_SQL}, r AS (SELECT *, {RULES_SQL} AS rules FROM log) SELECT {REQUEST_SQL} FROM r WHERE len(rules) = 0",
)
def ioc_anti(spark: SparkSession, sf: str) -> DataFrame:
    return indicators.drop_matched(_requests(spark, sf), LOG_INDICATORS)


# ---------------------------------------------------------------- whole cycle

CYCLE = DetectionParams(alpha=ALPHA, sigma=1.0, min_count=2, scope="all", lookback_minutes=T.LOG_MINUTES, top_k=200)
COUNTS_SQL = """SELECT 'request_count' AS metric, ip AS key, uri AS subkey, date_trunc('minute', log_time) AS minute,
      CAST(count(*) AS DOUBLE) AS value, 'WAF' AS source_type
    FROM log GROUP BY ip, uri, date_trunc('minute', log_time)
    UNION ALL
    SELECT 'connection_count', ip, CAST(CASE event_id % 4 WHEN 0 THEN 22 WHEN 1 THEN 80 WHEN 2 THEN 443 ELSE 3389 END AS VARCHAR),
      date_trunc('minute', log_time), CAST(count(*) AS DOUBLE), 'VPC'
    FROM log GROUP BY ip, event_id % 4, date_trunc('minute', log_time)"""
CYCLE_FOLD = folded_sql(COUNTS_SQL, extra="source_type", lead=T.LOG_SQL + ",")
# Every country and every agent of a finding's minute counts, not one of them.
TAGS_SQL = f""", seen AS (
      SELECT DISTINCT f.metric, f.key, f.subkey, f.minute, f.source_type, l.country, l.ua FROM found f LEFT JOIN log l
      ON f.source_type = 'WAF' AND l.ip = f.key AND l.uri = f.subkey AND date_trunc('minute', l.log_time) = f.minute),
    hits AS (SELECT metric, key, subkey, minute, unnest([{CIDR_SQL.replace('ip', 'key')}, {COUNTRY_SQL}, {UA_SQL}, {UA_REGEX_SQL},
      CASE WHEN source_type = 'WAF' THEN {URI_SQL.replace('uri', 'subkey')} END,
      CASE WHEN source_type = 'WAF' THEN {URI_REGEX_SQL.replace('(uri', '(subkey')} END]) AS rule FROM seen),
    tags AS (SELECT metric, key, subkey, minute, string_agg(rule, ' & ' ORDER BY rule) AS ioc_matches
      FROM (SELECT DISTINCT * FROM hits WHERE rule IS NOT NULL) GROUP BY metric, key, subkey, minute)"""


CYCLE_FOUND_SQL = """, scored AS (
      SELECT *, CASE WHEN rn > 2 THEN CASE WHEN pstd = 0 THEN 0 ELSE (value - pm) / pstd END END AS score FROM s),
    found AS (SELECT *, pm AS baseline_mean, pstd AS baseline_std, CASE WHEN score > 0 THEN 'high' ELSE 'low' END AS mode
      FROM scored WHERE abs(score) > 1.0)"""


@query(
    "detection_cycle",
    f"""{CYCLE_FOLD}{CYCLE_FOUND_SQL}{TAGS_SQL}
    SELECT metric, key, subkey, {TEXT_MINUTE}, value, round(score, 6) AS score, mode,
      coalesce(ioc_matches, '') AS ioc_matches FROM found LEFT JOIN tags USING (metric, key, subkey, minute)""",
)
def detection_cycle(spark: SparkSession, sf: str) -> DataFrame:
    counts = hotspots.union_counts(
        T.waf_logs(spark, sf), T.vpc_logs(spark, sf), T.AS_OF, T.LOG_MINUTES, None, with_ua=True
    )
    details = series.to_points(written(counts, "counts"))
    tagged = detect_and_tag(details, CYCLE.with_(top_k=None), LOG_INDICATORS).findings
    matches = F.coalesce(F.array_join("ioc_matches", " & "), F.lit(""))
    return tagged.select(
        *KEYS, when_text("minute"), "value", rounded("score"), "mode", matches.alias("ioc_matches")
    )


WEIGHTS = {"CIDR": 3.0, "Country": 1.0, "Country:KP": 4.0, "UA_Exact": 2.5, "URI_Regex": 0.5}
WEIGHT_SQL = "CASE WHEN rule = 'Country:KP' THEN 4 " + " ".join(
    f"WHEN starts_with(rule, '{k}:') THEN {v}" for k, v in WEIGHTS.items() if ":" not in k
) + " ELSE 1 END"


@query(
    "weighted_findings",
    f"""{CYCLE_FOLD}{CYCLE_FOUND_SQL}{TAGS_SQL},
    risks AS (SELECT metric, key, subkey, minute, sum({WEIGHT_SQL}) AS risk FROM (SELECT DISTINCT * FROM hits WHERE rule IS NOT NULL)
      GROUP BY metric, key, subkey, minute),
    ranked AS (SELECT found.*, coalesce(risk, 0) AS risk FROM found LEFT JOIN risks USING (metric, key, subkey, minute))
    SELECT metric, key, subkey, {TEXT_MINUTE}, round(score, 6) AS score, CAST(risk AS DOUBLE) AS risk FROM ranked
    ORDER BY ranked.risk DESC, abs(ranked.score) DESC, metric, key, subkey, ranked.minute LIMIT 50""",
)
def weighted_findings(spark: SparkSession, sf: str) -> DataFrame:
    """The fifty riskiest findings of a cycle, by what their indicators weigh."""
    counts = hotspots.union_counts(T.waf_logs(spark, sf), T.vpc_logs(spark, sf), T.AS_OF, T.LOG_MINUTES, None, with_ua=True)
    found = Indicators.from_config({**LOG_CONFIG, "weights": WEIGHTS})
    tagged = detect_and_tag(series.to_points(written(counts, "counts")), CYCLE.with_(top_k=None), found).findings
    ranked = indicators.ranked_by_risk(tagged, found, 50)
    return ranked.select(*KEYS, when_text("minute"), rounded("score"), "risk")


@query(
    "saved_cycle",
    f"""{CYCLE_FOLD}{CYCLE_FOUND_SQL}
    SELECT CASE WHEN minute < TIMESTAMP '2024-01-30 18:00:00' THEN '20240130T180000' ELSE '20240131T000000' END AS run_id,
      metric, key, subkey, {TEXT_MINUTE}, value, round(score, 6) AS score, mode FROM found""",
)
def saved_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Two scheduled cycles over the landed files; findings as saved by both.

    The second resumes from the first one's baselines, so together they find
    what one cycle over the whole time finds.
    """
    path = scratch_path(spark, "cycles")
    store = BaselineStore(spark, path + "/baselines")
    waf = logs.read_waf(spark, T.landed(spark, sf, "waf"))
    vpc = logs.read_vpc(spark, T.landed(spark, sf, "vpc"))
    half = T.LOG_MINUTES // 2
    params = CYCLE.with_(lookback_minutes=half, top_k=None)
    for as_of in (T.AS_OF - dt.timedelta(minutes=half), T.AS_OF):
        run_cycle(
            waf, vpc, as_of, params, store, path + "/points", path + "/findings", LOG_INDICATORS
        )
    saved = read_findings(spark, path + "/findings")
    return saved.select("run_id", *KEYS, when_text("minute"), "value", rounded("score"), "mode")


@query(
    "cycle_trained_from_history",
    f"""{CYCLE_FOLD}{CYCLE_FOUND_SQL}
    SELECT CASE WHEN minute < TIMESTAMP '2024-01-30 17:00:00' THEN '20240130T170000'
      WHEN minute < TIMESTAMP '2024-01-30 18:00:00' THEN '20240130T180000' ELSE '20240131T000000' END AS run_id,
      metric, key, subkey, {TEXT_MINUTE}, value, round(score, 6) AS score, mode FROM found""",
)
def cycle_trained_from_history(spark: SparkSession, sf: str) -> DataFrame:
    """Three cycles, the last with an empty baseline store.

    It trains from the counts that the first two saved, which overlap, and so finds
    what it would have found with their baselines.
    """
    path = scratch_path(spark, "trained")
    waf, vpc = logs.read_waf(spark, T.landed(spark, sf, "waf")), logs.read_vpc(spark, T.landed(spark, sf, "vpc"))
    half = T.LOG_MINUTES // 2
    params = CYCLE.with_(lookback_minutes=half, top_k=None, max_age_days=7)
    kept, lost = BaselineStore(spark, path + "/baselines"), BaselineStore(spark, path + "/other")
    for minutes, store in ((half + 60, kept), (half, kept), (0, lost)):
        as_of = T.AS_OF - dt.timedelta(minutes=minutes)
        run_cycle(waf, vpc, as_of, params, store, path + "/points", path + "/findings")
    saved = read_findings(spark, path + "/findings")
    return saved.select("run_id", *KEYS, when_text("minute"), "value", rounded("score"), "mode")


@query(
    "cycle_alerts",
    f"""{CYCLE_FOLD}{CYCLE_FOUND_SQL} SELECT CAST(n AS VARCHAR) || ' findings' AS subject, least(n, 100) AS n_listed, n AS n_metric
    FROM (SELECT count(*) AS n FROM found)""",
)
def cycle_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The alert document and the metric that a cycle writes for its findings."""
    path = scratch_path(spark, "alerts")
    waf, vpc = logs.read_waf(spark, T.landed(spark, sf, "waf")), logs.read_vpc(spark, T.landed(spark, sf, "vpc"))
    params = CYCLE.with_(top_k=None)
    store = BaselineStore(spark, path + "/baselines")
    run_cycle(
        waf, vpc, T.AS_OF, params, store, path + "/points", path + "/findings", LOG_INDICATORS, alerts_path=path
    )
    alert, metric = spark.read.text(path + "/alerts"), spark.read.text(path + "/metrics")
    document = F.from_json("value", "subject STRING, findings ARRAY<STRUCT<metric: STRING>>")
    told = alert.select(document.alias("d"), F.lit(1).alias("one"))
    n = F.from_json("value", f"{METRICS[0]} BIGINT")[METRICS[0]]
    return told.join(metric.select(n.alias("n_metric"), F.lit(1).alias("one")), "one").select(
        F.concat("n_metric", F.lit(" findings")).alias("subject"),
        F.size("d.findings").cast("bigint").alias("n_listed"),
        "n_metric",
    )


CAPPED_SQL = folded_sql(
    """SELECT metric, key, subkey, minute, sum(value) AS value, source_type FROM (
      SELECT * FROM (SELECT 'request_count' AS metric, ip AS key, uri AS subkey, date_trunc('minute', log_time) AS minute,
        CAST(count(*) AS DOUBLE) AS value, country, label AS rule_label, 'WAF' AS source_type FROM log
        GROUP BY ip, uri, date_trunc('minute', log_time), country, label
        ORDER BY value DESC, minute, key, subkey, country NULLS FIRST, rule_label NULLS FIRST LIMIT 200)
      UNION ALL
      SELECT * FROM (SELECT 'connection_count' AS metric, ip AS key,
        CAST(CASE event_id % 4 WHEN 0 THEN 22 WHEN 1 THEN 80 WHEN 2 THEN 443 ELSE 3389 END AS VARCHAR) AS subkey,
        date_trunc('minute', log_time) AS minute, CAST(count(*) AS DOUBLE) AS value, NULL, NULL, 'VPC'
        FROM log GROUP BY ip, event_id % 4, date_trunc('minute', log_time)
        ORDER BY value DESC, minute, key, subkey LIMIT 200)) GROUP BY metric, key, subkey, minute, source_type""",
    extra="source_type",
    lead=T.LOG_SQL + ",",
)


@query("capped_cycle", f"{CAPPED_SQL}{CYCLE_FOUND_SQL} SELECT {FOUND_COLUMNS} FROM found")
def capped_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """A cycle over the 200 largest groups of each source."""
    params = CYCLE.with_(hotspot_limit=200, top_k=None)
    return _found(plan_cycle(T.waf_logs(spark, sf), T.vpc_logs(spark, sf), T.AS_OF, params, LOG_INDICATORS).findings)


# Whole minutes before 20:17, folded once whatever the runs overlap.
NEWEST_SQL = folded_sql(
    f"""SELECT * FROM ({COUNTS_SQL}) WHERE minute >= TIMESTAMP '2024-01-30 20:02:00' AND minute < TIMESTAMP '2024-01-30 20:22:00'""",
    extra="source_type",
    lead=T.LOG_SQL + ",",
)


@query(
    "cycle_newest_minute",
    f"""{NEWEST_SQL} SELECT metric, key, subkey, strftime(max(minute), '%Y-%m-%d %H:%M:%S') AS last_minute,
    count(*) AS n, round(arg_max(m, minute), 6) AS mean FROM s GROUP BY metric, key, subkey""",
)
def cycle_newest_minute(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs with the default settings, five minutes apart and inside a minute:
    together they have folded every whole minute once, with all its groups."""
    path = scratch_path(spark, "newest")
    store = BaselineStore(spark, path + "/baselines")
    waf, vpc = logs.read_waf(spark, T.landed(spark, sf, "waf")), logs.read_vpc(spark, T.landed(spark, sf, "vpc"))
    for minute in (17, 22):
        as_of = dt.datetime(2024, 1, 30, 20, minute, 30, tzinfo=dt.timezone.utc)
        run_cycle(waf, vpc, as_of, DetectionParams(), store, path + "/points", path + "/findings", LOG_INDICATORS)
        store.compact()
        store.compact()
    kept = store.load()
    return kept.select(*KEYS, when_text("last_minute"), "n", rounded("mean"))


# ---------------------------------------------------------------- jobs

JOB_SQL = """SELECT c_nationkey, count(*) AS n_customers, max(c_acctbal) AS top_balance
FROM IDENTIFIER(:customers) WHERE c_acctbal >= :least GROUP BY c_nationkey
ORDER BY n_customers DESC, c_nationkey LIMIT ${TOP_K};"""


@query(
    "sql_job",
    """SELECT c_nationkey, count(*) AS n_customers, max(c_acctbal) AS top_balance FROM customer
    WHERE c_acctbal >= 100.0 GROUP BY c_nationkey ORDER BY n_customers DESC, c_nationkey LIMIT 10""",
)
def sql_job(spark: SparkSession, sf: str) -> DataFrame:
    T.table(spark, sf, "customer").createOrReplaceTempView("surgelens_customer")
    return sqljob.run_sql(
        spark, JOB_SQL, args={"customers": "surgelens_customer", "least": 100.0}, places={"TOP_K": 10}
    )


@query(
    "external_tables",
    f"""WITH {T.LOG_SQL} SELECT 'waf' AS source, strftime(log_time, '%H') AS hr, count(*) AS n_rows, count(ua) AS n_named,
      count(*) AS n_merged FROM log GROUP BY ALL UNION ALL
    SELECT 'vpc', strftime(log_time, '%H'), count(*), count(*), count(*) FROM log GROUP BY ALL""",
)
def external_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Both logs as catalog tables in a database of their own, read by the names of their merged views."""
    root = scratch_path(spark, "catalog")
    database = "logs_" + root[-8:]
    catalog.create_database(spark, database, root)
    for name, schema in (("waf", WAF), ("vpc", VPC)):
        catalog.register_external(spark, database, f"{name}_raw", schema, T.landed(spark, sf, name))
        catalog.register_merged(spark, database, f"{name}_logs", f"{name}_raw", name)
    text = """
    SELECT 'waf' AS source, hr, count(*) AS n_rows,
           count_if(exists(httpRequest.headers, h -> h.name = 'User-Agent')) AS n_named,
           count_if(httpRequest.httpMethod = 'GET' AND httpResponse.status = 200) AS n_merged
    FROM ${database}.waf_logs WHERE dt >= :day GROUP BY hr
    UNION ALL
    SELECT 'vpc', hr, count(*), count(account_id), count(log_status) FROM ${database}.vpc_logs WHERE dt >= :day GROUP BY hr"""
    return sqljob.run_sql(spark, text, args={"day": "2024-01-30"}, places={"database": database})


@query(
    "convert_roundtrip",
    f"""WITH {T.LOG_SQL} SELECT strftime(log_time, '%Y-%m-%d') AS dt, strftime(log_time, '%H') AS hr, ip AS client_ip, uri,
    ms AS timestamp FROM log""",
)
def convert_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    target = scratch_path(spark, "waf-parquet")
    convert.convert_day(spark, logs.read_waf, T.landed(spark, sf, "waf"), target, "2024-01-30")
    files = logs.read_waf(spark, target, "parquet")
    return files.select(
        "dt", "hr", F.col("httpRequest.clientIp").alias("client_ip"), F.col("httpRequest.uri").alias("uri"), "timestamp"
    )


@query(
    "convert_incremental",
    f"""WITH {T.LOG_SQL} SELECT strftime(log_time, '%Y-%m-%d') AS dt, strftime(log_time, '%H') AS hr, count(*) AS n_rows,
    CAST(sum(k) * 100 AS BIGINT) AS bytes FROM log GROUP BY ALL""",
)
def convert_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Hours that get a late file are converted again, whole; others stay."""
    source, target = scratch_path(spark, "vpc-late"), scratch_path(spark, "vpc-parquet")
    flows = spark.read.schema(VPC).json(T.landed(spark, sf, "vpc"))
    early = F.col("packets") < 60
    convert.write_partitioned(flows.where(early), source, fmt="json")
    convert.convert_new(spark, logs.read_vpc, source, target)
    convert.write_partitioned(flows.where(~early), source, fmt="json")
    convert.convert_new(spark, logs.read_vpc, source, target)
    convert.convert_new(spark, logs.read_vpc, source, target)
    files = logs.read_vpc(spark, target, "parquet")
    return files.groupBy("dt", "hr").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("bytes").alias("bytes"))


@query(
    "retention",
    """SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n_rows FROM events WHERE ts < TIMESTAMP '2024-01-21'
    GROUP BY strftime(ts, '%Y-%m-%d')""",
)
def retention(spark: SparkSession, sf: str) -> DataFrame:
    """Events landed by day; only folders of expired days are opened, and no column is read."""
    path = scratch_path(spark, "by-day")
    dated = T.table(spark, sf, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"))
    dated.hint("rebalance", "dt").write.partitionBy("dt").parquet(path)
    days = convert.expired_days(spark, path, T.AS_OF.date(), 10)
    landed = spark.read.schema("event_id bigint, dt string").parquet(path)
    return convert.expired_partitions(landed.where(F.col("dt").isin(days)), T.AS_OF.date(), 10)


# ---------------------------------------------------------------- streams


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


CLOSED_SQL = "(SELECT max(ts) FROM events) - INTERVAL 15 MINUTE"


@query(
    "stream_counts",
    f"""SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS value
    FROM (SELECT date_trunc('minute', ts) AS w, event_type FROM events) WHERE w + INTERVAL 1 MINUTE <= {CLOSED_SQL}
    GROUP BY w, event_type""",
)
def stream_minutes(spark: SparkSession, sf: str) -> DataFrame:
    """Closed one-minute windows of the event stream."""
    path = scratch_path(spark, "stream-counts")
    counts = stream_counts.windowed_counts(_event_stream(spark, sf), "ts", ["event_type"])
    stream_counts.to_parquet(counts, path + "/rows", path + "/checkpoint").awaitTermination()
    return spark.read.parquet(path + "/rows").select(when_text("window_start"), "event_type", "value")


@query(
    "stream_sliding",
    f"""WITH starts AS (
      SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') - to_minutes(5 * i) AS w
      FROM events, generate_series(0, 2) AS g(i))
    SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS value
    FROM starts WHERE w + INTERVAL 15 MINUTE <= {CLOSED_SQL} GROUP BY w, event_type""",
)
def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stream-sliding")
    counts = stream_counts.windowed_counts(
        _event_stream(spark, sf), "ts", ["event_type"], "15 minutes", "5 minutes"
    )
    stream_counts.to_parquet(counts, path + "/rows", path + "/checkpoint").awaitTermination()
    return spark.read.parquet(path + "/rows").select(when_text("window_start"), "event_type", "value")


STREAM_POINTS = f"SELECT * FROM ({T.HOURLY_SQL}) WHERE minute + INTERVAL 1 HOUR <= {CLOSED_SQL}"


@query(
    "stream_baseline",
    f"""{folded_sql(STREAM_POINTS)} SELECT metric, key, subkey, {TEXT_MINUTE}, value,
    round(CASE WHEN rn > 5 THEN CASE WHEN pstd = 0 THEN 0 ELSE (value - pm) / pstd END END, 6) AS score,
    round(pm, 6) AS baseline_mean, round(pstd, 6) AS baseline_std FROM s""",
)
def stream_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts as one stream, scored by a second one that keeps the state."""
    path = scratch_path(spark, "stream-baseline")
    hourly = stream_counts.windowed_counts(_event_stream(spark, sf), "ts", ["event_type"], "1 hour")
    stream_counts.to_parquet(hourly, path + "/hourly", path + "/checkpoint-1").awaitTermination()
    points = (
        spark.readStream.schema(spark.read.parquet(path + "/hourly").schema)
        .parquet(path + "/hourly")
        .select(
            F.lit("event_count").alias("metric"), F.col("event_type").alias("key"),
            F.col("window_start").alias("minute"), "value",
        )
    )
    scored = stream_baseline.scored_stream(points, HOURLY)
    stream_counts.to_parquet(scored, path + "/scored", path + "/checkpoint-2").awaitTermination()
    return spark.read.parquet(path + "/scored").select(
        *KEYS, when_text("minute"), "value", rounded("score"), rounded("baseline_mean"), rounded("baseline_std")
    )


@query(
    "stream_cycles",
    f"""{folded_sql(STREAM_POINTS)} SELECT metric, key, subkey, round(m, 6) AS mean, round(coalesce(std, 0), 6) AS std,
    rn AS n FROM s {LAST_SQL}""",
)
def stream_cycles(spark: SparkSession, sf: str) -> DataFrame:
    """Baselines left behind by a scheduled detection over a stream of counts."""
    path = scratch_path(spark, "stream-cycles")
    hourly = stream_counts.windowed_counts(_event_stream(spark, sf), "ts", ["event_type"], "1 hour")
    stream_counts.to_parquet(hourly, path + "/hourly", path + "/checkpoint-1").awaitTermination()
    points = (
        spark.readStream.schema(spark.read.parquet(path + "/hourly").schema)
        .parquet(path + "/hourly")
        .select(
            F.lit("event_count").alias("metric"), F.col("event_type").alias("key"),
            F.col("window_start").alias("minute"), "value",
        )
    )
    store = BaselineStore(spark, path + "/baselines")
    stream_baseline.scheduled_cycles(
        points, HOURLY, store, path + "/findings", path + "/checkpoint-2", once=True
    ).awaitTermination()
    return store.load().select(*KEYS, rounded("mean"), rounded("std"), "n")


@query(
    "stream_ingest",
    """SELECT CASE WHEN k % 10 = 9 THEN 'error' ELSE 'record' END AS landed, count(*) AS n_rows, 0 AS n_changed
    FROM (SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events) GROUP BY ALL""",
)
def stream_land(spark: SparkSession, sf: str) -> DataFrame:
    """Raw lines landed by arrival hour; lines that do not parse go aside."""
    path = scratch_path(spark, "stream-ingest")
    _broken_lines(spark, sf).write.text(path + "/lines")
    lines = spark.readStream.text(path + "/lines")
    started = stream_ingest.ingest_text(
        lines, WAF, path + "/records", path + "/errors", path + "/checkpoint", once=True
    )
    for one in started:
        one.awaitTermination()
    landed = [spark.read.text(f"{path}/{k}s").select("value", F.lit(k).alias("landed")) for k in ("record", "error")]
    whole = landed[0].unionAll(landed[1])
    known = spark.read.text(path + "/lines").select("value", F.lit(1).alias("known")).distinct()
    changed = F.sum(F.when(F.col("known").isNull(), 1).otherwise(0)).cast("int").alias("n_changed")
    return whole.join(known, "value", "left").groupBy("landed").agg(F.count(F.lit(1)).alias("n_rows"), changed)


CLOSED_COUNTS_SQL = f"""SELECT * FROM ({COUNTS_SQL})
    WHERE minute + INTERVAL 1 MINUTE <= (SELECT max(log_time) FROM log) - INTERVAL 15 MINUTE"""


@query(
    "stream_landing",
    f"""{folded_sql(CLOSED_COUNTS_SQL, extra="source_type", lead=T.LOG_SQL + ",")}{CYCLE_FOUND_SQL}
    SELECT metric, key, subkey, {TEXT_MINUTE}, value, round(score, 6) AS score, mode FROM found""",
)
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Log files that land in two deliveries, scored by one stream over both tables."""
    path = scratch_path(spark, "stream-landing")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    store, params = BaselineStore(spark, path + "/baselines", buckets), CYCLE.with_(top_k=None)
    for early in (True, False):
        for kind in ("waf", "vpc"):
            lines = spark.read.schema("value string, dt string, hr string").text(T.landed(spark, sf, kind))
            due = lines.where((F.col("hr") < "18") == early)
            due.write.mode("append").partitionBy("dt", "hr").text(f"{path}/{kind}")
        stream_landings.landing_cycles(
            spark, path + "/waf", path + "/vpc", params, store, path + "/counts", path + "/findings", path + "/checkpoint",
            LOG_INDICATORS, once=True,
        ).awaitTermination()
    saved = read_findings(spark, path + "/findings")
    return saved.select(*KEYS, when_text("minute"), "value", rounded("score"), "mode")


# Every seventh event is delivered a week late; deliveries come in batches of a week.
ARRIVAL_SQL = "ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL 7 DAY ELSE INTERVAL 0 DAY END"
BATCH_SQL = f"(epoch_us({ARRIVAL_SQL}) - {T.MONTH_MS} * 1000) // 604800000000"


@query(
    "stream_accounted",
    f"""WITH e AS (SELECT *, {BATCH_SQL} AS b FROM events),
    seen AS (SELECT b, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM e GROUP BY b),
    split AS (SELECT e.*, coalesce(ts < newest - INTERVAL 15 MINUTE, false) AS late FROM e JOIN seen USING (b))
    SELECT CASE WHEN late THEN 'late' WHEN date_trunc('hour', ts) + INTERVAL 1 HOUR <= {CLOSED_SQL} THEN 'closed' ELSE 'open' END AS kind,
      strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS value
    FROM split GROUP BY ALL""",
)
def stream_accounted(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly counts of events that come out of order, and what came too late."""
    path = scratch_path(spark, "stream-accounted")
    late = F.expr("CASE WHEN event_id % 7 = 0 THEN 7 ELSE 0 END")
    micros = F.unix_micros(F.col("ts").cast("timestamp")) + late * 86_400_000_000 - T.MONTH_MS * 1000
    events = T.table(spark, sf, "events")
    week = F.call_function("div", micros, F.lit(604_800_000_000))
    weeks = [r[0] for r in events.select(week.alias("w")).distinct().orderBy("w").collect()]
    for w in weeks:
        events.where(week == w).write.mode("append").parquet(path + "/landed")
        stream = spark.readStream.schema(events.schema).parquet(path + "/landed")
        stream_counts.accounted_counts(stream, "ts", ["event_type"], path, path + "/checkpoint", "1 hour").awaitTermination()
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    refused = stream_counts.late_rows(spark, path).groupBy(hour.alias("window_start"), "event_type").agg(F.count(F.lit(1)).alias("value"))
    kinds = {"closed": stream_counts.closed_counts(spark, path), "open": stream_counts.open_counts(spark, path), "late": refused}
    parts = [df.select(F.lit(k).alias("kind"), when_text("window_start"), "event_type", "value") for k, df in kinds.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
