"""What the operators of this package share: inputs, scratch tables, word rules."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.session import scratch_path, utc

# Most rows, and bytes, of one batch handed to a Python worker.
BATCH_ROWS = 1000
BATCH_BYTES = 16 * 1024 * 1024

# Words of letters and digits: lower-case A-Z; every other ASCII byte divides.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
SPACES = b" \t\n\x0b\x0c\r"


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased words of letters and digits; bytes above ASCII belong to words."""
    return text.translate(WORD_BYTES).split() if text else []


def spaced_words(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space."""
    return text.split() if text else []


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("doc_id", "text")))


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch can hold, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def raw(df: DataFrame, text: str = "text", **named: str) -> DataFrame:
    """Only the columns an operator uses, the text as bytes, under fixed names."""
    return df.select(*(F.col(f"`{c}`").alias(n) for n, c in named.items()), F.col(f"`{text}`").cast("binary").alias("text"))


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back: a cut of the lineage
    that outlives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't use."""
    taken = {c.lower() for c in df.columns}
    return base if base not in taken else f"{base}_{uuid.uuid4().hex[:8]}"
