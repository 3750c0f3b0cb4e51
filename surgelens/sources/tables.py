"""Databases and external log tables in the Spark catalog."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import DataType, StructType

from surgelens.sources.schemas import VPC, WAF
from surgelens.sources.sqljob import identifier


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    text = f"CREATE DATABASE IF NOT EXISTS {identifier(name)}"
    if location:
        spark.sql(text + " LOCATION :location", args={"location": location})
    else:
        spark.sql(text)


def register_external(
    spark: SparkSession, database: str, table: str, schema: StructType, location: str, fmt: str = "json"
) -> str:
    """An external table over files laid out as ``dt=/hr=``; returns its name."""
    full = f"{identifier(database)}.{identifier(table)}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {full} ({columns}) USING {identifier(fmt)}"
        " PARTITIONED BY (dt, hr) LOCATION :location",
        args={"location": location},
    )
    spark.catalog.recoverPartitions(full)
    return full


def _merged(path: str, kind: DataType, twins: dict[str, dict[str, str]]) -> str:
    """SQL of a struct whose fields take another spelling's value where they have none."""
    if path not in twins:
        return f"`{path}`"
    pairs = twins[path]
    fields = [f for f in kind.fieldNames() if f not in pairs.values()]
    values = [f"coalesce({path}.{f}, {path}.{pairs[f]})" if f in pairs else f"{path}.{f}" for f in fields]
    inside = ", ".join(f"'{f}', {v}" for f, v in zip(fields, values))
    return f"CASE WHEN {path} IS NOT NULL THEN named_struct({inside}) END"


def register_merged(spark: SparkSession, database: str, view: str, table: str, kind: str) -> str:
    """A catalog view over a raw table (``kind``: waf or vpc) with both spellings of a field merged."""
    full = f"{identifier(database)}.{identifier(view)}"
    schema = WAF if kind == "waf" else VPC
    names = schema.fieldNames()
    twins = {
        "httpRequest": {"httpMethod": "method"},
        "httpResponse": {"status": "statusCode", "responseCodeSent": "responsecode_sent"},
    }
    columns = []
    for field in schema.fields:
        dashed = field.name.replace("_", "-")
        if "-" in field.name:
            continue
        if dashed != field.name and dashed in names:
            columns.append(f"coalesce(`{field.name}`, `{dashed}`) AS `{field.name}`")
        else:
            columns.append(f"{_merged(field.name, field.dataType, twins)} AS `{field.name}`")
    spark.sql(f"CREATE OR REPLACE VIEW {full} AS SELECT {', '.join(columns)} FROM {identifier(database)}.{identifier(table)}")
    return full
