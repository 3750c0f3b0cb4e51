"""The queries of this package; ``ORACLES`` holds the SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surgelens.llm import binpack, langbits, license_join, linefirst, oracles, pitman_yor, positional, prefix_trie
from surgelens.llm import quotes, repair, rulefit, simhash, skipchain, splitters
from surgelens.llm.common import documents, stored
from surgelens.session import utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return run

    return register


@query("op10_line_first_cleaning", oracles.LINE_FIRST)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linefirst.assess(documents(spark, sf_dir))


@query("op7_positional_index", oracles.POSITIONAL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = positional.contamination(documents(spark, sf_dir), benchmark, window=10)
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.after - s.first)")
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.size("near_items").cast("long").alias("n_near_items"),
    )


@query("op6_simhash_blocks")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=3)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op2_bin_completion")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return binpack.pack(documents(spark, sf_dir), capacity=1024, end_id=2)


@query("op4_sampled_splitters")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = splitters.assign(documents(spark, sf_dir), n_shards=8)
    law = F.lit("bytes").alias("law")
    return found.select("doc_id", "size", "text_crc32", law, "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query("op9_license_set_join", oracles.LICENSES)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan(documents(spark, sf_dir)).drop("blocks")


def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return utc(spark).read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")


def quoting_messages(spark: SparkSession, sf_dir: str, levels: int = 3) -> DataFrame:
    """The conversations as mail: every turn quotes up to three turns before it.

    All rows are messages, numbered by conversation, turn, role and text; rows
    without a conversation quote nothing.
    """
    turns = quotes.numbered_messages(conversations(spark, sf_dir), ["conv_id", "turn", "role", "text"])
    mail = turns
    for k in range(1, levels + 1):
        marks = ">" * k + " "
        quoted = F.concat(F.lit(marks), F.regexp_replace("text", "\n", "\n" + marks), F.lit("\n"))
        # Messages of a conversation have numbers in a row.
        earlier = turns.select(F.col("conv_id").alias("_conv"), (F.col("id") + k).alias("_id"), quoted.alias(f"quote{k}"))
        mail = mail.join(earlier, (F.col("id") == F.col("_id")) & (F.col("conv_id") == F.col("_conv")), "left").drop("_conv", "_id")
    above = [F.coalesce(f"quote{k}", F.lit("")) for k in range(levels, 0, -1)]
    body = F.concat(*above, F.lit("\n"), F.coalesce("text", F.lit("")))
    return stored(mail.select("conv_id", "turn", "id", body.alias("text")), "mail")


@query(
    "op1_quotation_linking",
    r"""
    WITH numbered AS (
        SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS id,
            regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g') AS own FROM conversations),
    -- A turn without words quotes nothing; then the turn before that one is the lowest level quoted.
    linked AS (
        SELECT a.conv_id, a.turn, a.id, a.own, max(b.id) AS parent_id FROM numbered a LEFT JOIN numbered b
        ON a.conv_id = b.conv_id AND b.id BETWEEN a.id - 3 AND a.id - 1 AND b.own <> '' GROUP BY ALL),
    chains AS (SELECT *, sum(CASE WHEN parent_id IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY id) AS chain FROM linked)
    SELECT conv_id, turn, id AS message_id, parent_id,
        min(id) OVER (PARTITION BY chain) AS root_id,
        row_number() OVER (PARTITION BY chain ORDER BY id) - 1 AS depth,
        row_number() OVER (PARTITION BY chain ORDER BY id) - 1 AS position,
        sha256(own) AS text_sha256
    FROM chains
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    mail = quoting_messages(spark, sf_dir)
    found = quotes.conversations(mail)
    return mail.select("conv_id", "turn", "id").join(found, "id").select(
        "conv_id",
        "turn",
        F.col("id").alias("message_id"),
        "parent_id",
        "root_id",
        F.col("depth").cast("long").alias("depth"),
        "position",
        F.sha2(F.col("text"), 256).alias("text_sha256"),
    )


@query("op8_language_bits")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    model = langbits.learn(docs.filter(langbits.residue("doc_id", 4) != 2))
    found = langbits.predict(docs, model)
    held = (langbits.residue("doc_id", 4) == 2).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")


@query("op5_skip_chain_field")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = skipchain.detect(docs, skipchain.learn(docs))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in skipchain.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query("op3_pitman_yor")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("train", langbits.residue("doc_id", 10) != 0)
    found = pitman_yor.score(docs)
    held = (~F.col("train")).alias("held_out")
    return found.select("doc_id", held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_grammar_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations(spark, sf_dir)
    return repair.repair(repair.damaged(rows), rows)


@query("op12_rule_ensemble")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    found = rulefit.classify(documents(spark, sf_dir), labels, langbits.residue("doc_id", 5) != 0, least=0.3)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "score", "predicted")


@query("op13_prefix_trie", oracles.PREFIX_TRIE)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(conversations(spark, sf_dir))
