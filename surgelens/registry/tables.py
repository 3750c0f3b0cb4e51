"""The given tables, and security logs that Spark derives from ``events``.

Every event becomes one web request and one network flow. Log time runs sixty
times faster than event time, so the month of events fills the twelve hours
before ``AS_OF``. The SQL texts below derive the same rows for DuckDB.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surgelens.functions.scalars import day_label, hour_label
from surgelens.session import scratch_path, utc
from surgelens.sources.convert import write_partitioned

AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
LOG_MINUTES = 720
# First millisecond of the events' month, and of the log time.
MONTH_MS = 1704067200000
LOG_MS = 1706616000000


_schemas: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table. Its footer is read for the schema once per session."""
    path = f"{sf_dir}/{name}.parquet"
    slot = (spark.sparkContext.applicationId, path)
    if slot not in _schemas:
        _schemas[slot] = spark.read.parquet(path).schema
    return utc(spark).read.schema(_schemas[slot]).parquet(path)


COUNTRIES = ["US", "KR", "RU", "KP", None]
AGENTS = ["Mozilla/5.0", "curl/8.1", "masscan", "sqlmap/1.5", None]
PATHS = ["/.env", "/etc/passwd", "/search?q=Union+Select+1"]
PORTS = [22, 80, 443, 3389]


def _sql_case(selector: str, values: list[str | None]) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {selector} {arms} END"


def _log_columns(events: DataFrame) -> DataFrame:
    k = F.from_json("props", "k INT")["k"]
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    log_ms = F.call_function("div", millis - F.lit(MONTH_MS), F.lit(60)) + F.lit(LOG_MS)
    who = F.col("user_id") % 5
    # Countries and agents differ between requests of one address and minute.
    home, tool = F.col("event_id") % 5, F.call_function("div", F.col("event_id"), F.lit(5)) % 5
    return events.select(
        "event_id",
        "event_type",
        k.alias("k"),
        who.alias("who"),
        home.alias("home"),
        tool.alias("tool"),
        log_ms.alias("ms"),
        F.concat(F.lit("10.0.0."), (who + 98).cast("string")).alias("ip"),
    )


def waf_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested web-request records, in the layout of the log scan."""
    e = _log_columns(table(spark, sf_dir, "events"))
    agent = F.expr(_sql_case("tool", AGENTS))
    pair = lambda n, v: F.struct(F.lit(n).alias("name"), v.alias("value"))
    host = pair("Host", F.lit("example.com"))
    headers = F.when(agent.isNotNull(), F.array(host, pair("User-Agent", agent))).otherwise(F.array(host))
    label = F.struct(F.concat(F.lit("rule:"), F.col("event_type")).alias("name"))
    labels = F.when(F.col("k") < 50, F.array(label, F.struct(F.lit("second").alias("name")))).otherwise(
        F.array().cast("array<struct<name:string>>")
    )
    path = F.coalesce(F.expr(_sql_case("k % 10", PATHS)), F.concat(F.lit("/"), F.col("event_type")))
    return e.select(
        F.col("ms").alias("timestamp"),
        F.lit(1).alias("formatVersion"),
        F.struct(
            F.concat(F.lit("rule-"), (F.col("k") % 3).cast("string")).alias("ruleId"),
            F.when(F.col("event_type") == "error", "BLOCK").otherwise("ALLOW").alias("action"),
        ).alias("terminatingRule"),
        F.struct(
            F.col("ip").alias("clientIp"),
            F.expr(_sql_case("home", COUNTRIES)).alias("country"),
            headers.alias("headers"),
            path.alias("uri"),
            F.lit("GET").alias("method"),
        ).alias("httpRequest"),
        F.struct(F.lit(200).alias("statusCode")).alias("httpResponse"),
        labels.alias("labels"),
    )


def vpc_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Network-flow records with dashed field names, as some writers emit them."""
    e = _log_columns(table(spark, sf_dir, "events"))
    start = F.call_function("div", F.col("ms"), F.lit(1000))
    port = F.get(F.array(*[F.lit(p) for p in PORTS]), (F.col("event_id") % len(PORTS)).cast("int"))
    return e.select(
        F.lit(2).alias("version"),
        F.lit("123456789012").alias("account-id"),
        F.lit("eni-1").alias("interface-id"),
        F.col("ip").alias("srcaddr"),
        F.concat(F.lit("10.1.0."), F.col("k").cast("string")).alias("dstaddr"),
        (F.lit(1024) + F.col("event_id") % 60000).cast("int").alias("srcport"),
        port.alias("dstport"),
        F.when(F.col("event_id") % 10 == 0, F.lit(17)).otherwise(F.lit(6)).cast("bigint").alias("protocol"),
        F.col("k").cast("bigint").alias("packets"),
        (F.col("k") * 100).cast("bigint").alias("bytes"),
        start.alias("start"),
        (start + 5).alias("end"),
        F.when(F.col("event_type") == "error", "REJECT").otherwise("ACCEPT").alias("action"),
        F.lit("OK").alias("log-status"),
    )


_landed: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """The derived logs written once per session as gzip JSON below ``dt=/hr=``."""
    slot = (spark.sparkContext.applicationId, sf_dir, kind)
    if slot not in _landed:
        path = scratch_path(spark, f"{kind}-logs")
        if kind == "waf":
            logs, at = waf_logs(spark, sf_dir), F.timestamp_millis("timestamp")
        else:
            logs, at = vpc_logs(spark, sf_dir), F.timestamp_seconds("start")
        dated = logs.withColumns({"dt": day_label(at), "hr": hour_label(at)})
        write_partitioned(dated, path, fmt="json")
        _landed[slot] = path
    return _landed[slot]


def hourly_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour and type, as points."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(F.col("event_type").alias("key"), F.date_trunc("hour", "ts").alias("minute"))
        .agg(F.count(F.lit(1)).alias("value"))
        .withColumn("metric", F.lit("event_count"))
    )


def daily_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day, user and type, as points."""
    return (
        table(spark, sf_dir, "events")
        .groupBy(
            F.col("user_id").cast("string").alias("key"),
            F.col("event_type").alias("subkey"),
            F.date_trunc("day", "ts").alias("minute"),
        )
        .agg(F.count(F.lit(1)).alias("value"))
        .withColumn("metric", F.lit("event_count"))
    )


LOG_SQL = f"""
log AS (
  SELECT event_id, event_type, who, k, ms, make_timestamp(ms * 1000) AS log_time,
         '10.0.0.' || (who + 98) AS ip, {_sql_case('event_id % 5', COUNTRIES)} AS country,
         {_sql_case('event_id // 5 % 5', AGENTS)} AS ua,
         coalesce({_sql_case('k % 10', PATHS)}, '/' || event_type) AS uri,
         CASE WHEN k < 50 THEN 'rule:' || event_type END AS label
  FROM (SELECT event_id, event_type, user_id % 5 AS who,
               CAST(json_extract(props, '$.k') AS INTEGER) AS k,
               (epoch_us(ts) // 1000 - {MONTH_MS}) // 60 + {LOG_MS} AS ms FROM events)
)"""

HOURLY_SQL = """
SELECT 'event_count' AS metric, event_type AS key, 'N/A' AS subkey,
       date_trunc('hour', ts) AS minute, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY event_type, date_trunc('hour', ts)"""

DAILY_SQL = """
SELECT 'event_count' AS metric, CAST(user_id AS VARCHAR) AS key, event_type AS subkey,
       date_trunc('day', ts) AS minute, CAST(count(*) AS DOUBLE) AS value
FROM events GROUP BY user_id, event_type, date_trunc('day', ts)"""
