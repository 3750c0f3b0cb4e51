"""Raw record ingest into ``dt=/hr=`` folders by arrival time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from surgelens.functions.scalars import day_label, hour_label


def by_arrival(records: DataFrame) -> DataFrame:
    now = F.current_timestamp()
    return records.withColumns({"dt": day_label(now), "hr": hour_label(now)})


def ingest(
    records: DataFrame, path: str, checkpoint: str, seconds: int = 300, once: bool = False
) -> StreamingQuery:
    """Write a stream of records as gzip files every ``seconds``; ``once`` drains it.

    Lines of text (one column, ``value``) are kept as they came, other records
    become JSON. Failed batches leave no files: the sink's log names complete ones.
    """
    writer = (
        by_arrival(records)
        .writeStream.format("text" if records.columns == ["value"] else "json")
        .option("compression", "gzip")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("dt", "hr")
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{seconds} seconds")
    return writer.start()


def ingest_text(
    lines: DataFrame, schema: StructType, path: str, errors: str, checkpoint: str, seconds: int = 300, once: bool = False
) -> list[StreamingQuery]:
    """Land a stream of JSON ``value`` lines unchanged; lines that do not parse go to
    ``errors``. Parsing only routes them: fields outside ``schema`` stay in the line."""
    with_text = StructType(list(schema.fields)).add("_bad", StringType())
    parsed = F.from_json("value", with_text, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.select("value", parsed.alias("r"))
    bad = F.col("r").isNull() | F.col("r._bad").isNotNull()
    good_rows, bad_rows = rows.where(~bad).select("value"), rows.where(bad).select("value")
    return [
        ingest(good_rows, path, checkpoint + "/records", seconds, once),
        ingest(bad_rows, errors, checkpoint + "/errors", seconds, once),
    ]
