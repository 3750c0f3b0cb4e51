"""The corpus pipeline: documents in, packed training sequences out.

Every stage is a function of the documents that its predecessor kept, written as
Parquet in between. All but the last keep the columns of ``documents``; other
columns are carried along. Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.llm import binpack, linefirst, positional, simhash, skipchain
from surgelens.llm.common import stored


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the changed texts, in a table that has such a column."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that fail, or lose too much, go."""
    return _counted(linefirst.clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.deduplicate(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of a benchmark item go."""
    return positional.uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return _counted(skipchain.redact(docs, skipchain.learn(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024."""
    return binpack.pack(docs, capacity=1024, end_id=2)


STAGES = [
    ("quality rules", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("best-fit packing", packing),
]

# Message passing and word-piece ids can't be expressed in SQL; the tests compare
# the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
