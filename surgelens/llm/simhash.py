"""SimHash near-duplicates: pigeonhole blocks, a join on blocks, a Hamming check.

A fingerprint is cut into ``blocks`` runs of bits. Two fingerprints that differ
in at most ``max_bits`` bits agree in at least ``blocks - max_bits`` runs, so
every choice of that many runs gives a key that all such pairs share for some
choice. More runs make longer keys: ``blocks_for`` takes as many as keep chance
meetings below the number of keys, so the work grows as the input does.

Fingerprints are made distinct first; copies cost one row. Keys that many
distinct fingerprints share (a crowd of near copies) are cut anew on their free
bits, level by level, until a key holds at most ``CROWD`` of them; a key whose
free bits are no more than ``max_bits`` links everything it holds. Within a key
the sorted rows stream through a worker, which checks the distances and passes
on a spanning forest, never all pairs. Components follow from the forests.

Null and empty texts have no words: their fingerprint is zero and they link like
any other. Repeated rows and rows without an id are rows of their own; the id of
a component is the least id in it, null if none has one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from surgelens.llm.common import free_name, raw, small_batches, stored
from surgelens.llm.components import components

BITS = 64
# Most distinct fingerprints compared under one key.
CROWD = 2048


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Majority bits over the XXH64 (seed 42) of all shingles of a text."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = len(words) - shingle + 1
    hashed = xxhash.xxh64_intdigest
    if n < 2:
        hashes = [hashed(b" ".join(words), 42)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *ends[: n - 1].tolist()]
        hashes = [hashed(joined[a:b], 42) for a, b in zip(starts, (ends[shingle - 1 :] - 1).tolist())]
    values = np.array(hashes, np.uint64)
    bits = np.unpackbits(values.view(np.uint8), bitorder="little")
    votes = np.zeros(BITS, np.int64)
    for part in np.split(bits, range(255 * BITS, len(bits), 255 * BITS)):
        votes += part.reshape(-1, BITS).sum(0, dtype=np.uint8)
    chosen = np.packbits(2 * votes > len(values), bitorder="little")
    return int(chosen.view(np.int64)[0])


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """Signed 64-bit fingerprints of a column of texts as bytes."""

    @F.pandas_udf(LongType())
    def marked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint(t, shingle) for t in batch], dtype="int64")

    return marked(text)


def _cuts(bits: list[int], blocks: int) -> list[list[int]]:
    return [part.tolist() for part in np.array_split(np.array(bits), blocks)]


def _masks(bits: list[int], blocks: int, max_bits: int) -> list[list[int]]:
    """For every choice of runs that close pairs may share: the bits left free."""
    runs = _cuts(bits, blocks)
    return [sorted(sum(free, [])) for free in combinations(runs, max_bits)]


def blocks_for(n: int, max_bits: int) -> int:
    """Runs to cut into for ``n`` fingerprints: chance pairs stay below the keys."""
    blocks = max_bits + 1
    while blocks < 16 and n > 2 ** (1 + (BITS * (blocks - max_bits)) // blocks):
        blocks += 1
    return blocks


def _signed(bits: list[int]) -> int:
    """A signed 64-bit number with the given bits set."""
    return int(np.uint64(sum(1 << b for b in bits)).view(np.int64))


def _bits(mask: int) -> list[int]:
    return [b for b in range(BITS) if mask >> b & 1]


def forest(prints: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the close pairs among distinct fingerprints."""
    left = prints.view(np.uint64).copy()
    edges = []
    while len(left) > 1:
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            centre = reached.pop()
            near = np.bitwise_count(left ^ centre) <= max_bits
            found, left = left[near], left[~near]
            edges += [(centre, other) for other in found]
            reached += list(found)
    return edges


def _forests(max_bits: int):
    """Streams rows sorted by key; a key's rows are bounded by ``crowd``."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            free, rest, prints = (batch.column(c).to_numpy() for c in ("free", "rest", "fp"))
            cuts = np.flatnonzero((free[1:] != free[:-1]) | (rest[1:] != rest[:-1])) + 1
            edges = []
            for at, part in zip([0, *cuts.tolist()], np.split(prints, cuts)):
                if not len(part):
                    continue
                if (own := (int(free[at]), int(rest[at]))) != key:
                    edges += forest(np.concatenate(held), max_bits) if sum(map(len, held)) > 1 else []
                    key, held = own, []
                held.append(part)
            yield _pairs(edges)
        if sum(map(len, held)) > 1:
            yield _pairs(forest(np.concatenate(held), max_bits))

    return stream


def _pairs(edges: list) -> pa.RecordBatch:
    both = np.array(edges, np.uint64).reshape(-1, 2).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def _keyed(rows: DataFrame) -> DataFrame:
    """A key is its free bits and the values of all others."""
    return rows.select("fp", "free", F.col("fp").bitwiseAND(F.bitwise_not("free")).alias("rest"))


def links(prints: DataFrame, max_bits: int = 3, blocks: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` that connect exactly what
    pairs of at most ``max_bits`` differing bits connect."""
    spark = prints.sparkSession
    blocks = blocks or blocks_for(prints.count(), max_bits)
    first = ",".join(f"{_signed(free)}L" for free in _masks(list(range(BITS)), blocks, max_bits))
    rows = _keyed(prints.select("fp", F.explode(F.expr(f"array({first})")).alias("free")))
    key, parts = ["free", "rest"], []
    while True:
        shared = stored(rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1"), "block-sizes")
        cold = rows.join(shared.filter(f"n <= {crowd}").select(*key), key, "left_semi")
        parts.append(cold.repartition(*key).sortWithinPartitions(*key).mapInArrow(_forests(max_bits), "a long, b long"))
        hot = shared.filter(f"n > {crowd}").select(*key)
        # As many rows as there are ways to choose runs, whatever the data.
        frees = sorted(r["free"] for r in hot.select("free").distinct().collect())
        if not frees:
            break
        crowded = rows.join(hot, key, "left_semi")
        near = [f for f in frees if len(_bits(f % 2**BITS)) <= max_bits]
        if near:
            own = crowded.filter(F.col("free").isin(near))
            parts.append(own.join(own.groupBy(*key).agg(F.min("fp").alias("a")), key).select("a", F.col("fp").alias("b")).filter("a <> b"))
        finer = []
        for f in set(frees) - set(near):
            bits = _bits(f % 2**BITS)
            finer += [(f, _signed(free)) for free in _masks(bits, min(len(bits), max_bits + 3), max_bits)]
        if not finer:
            break
        table = spark.createDataFrame(finer, "free long, next long")
        rows = stored(_keyed(crowded.join(F.broadcast(table), "free").select("fp", F.col("next").alias("free")).distinct()), "finer-blocks")
    edges = parts[0]
    for part in parts[1:]:
        edges = edges.unionAll(part)
    return edges


def classes(prints: DataFrame, max_bits: int = 3, blocks: int | None = None, crowd: int = CROWD) -> DataFrame:
    """(fp, root): the component of every linked fingerprint that isn't its own root."""
    found = components(links(prints, max_bits, blocks, crowd))
    return found.select(F.col("a").alias("fp"), F.col("b").alias("root"))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3
) -> DataFrame:
    """A row per row of ``docs``: doc_id, fp (signed) and component_id."""
    small_batches(docs.sparkSession)
    own = raw(docs, text, doc_id=doc_id).select("doc_id", fingerprints(F.col("text"), shingle).alias("fp"))
    own = stored(own, "fingerprints")
    prints = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = prints.join(classes(prints.select("fp"), max_bits), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(roots.select("fp", "root").join(least, "root"), "component-ids")
    return own.join(named.select("fp", "component_id"), "fp", "left").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component, that of the least id.

    Repeated rows of an id are one document: one stays. Of components without any
    id one row stays.
    """
    found = near_duplicates(docs, doc_id, text, shingle, max_bits)
    least = found.filter("doc_id = component_id")
    keep = stored(least.groupBy("doc_id").count().select(F.col("doc_id").alias("_kept_id"), (F.col("count") > 1).alias("_repeated")), "kept")
    id_name, repeated = free_name(docs, "kept_id"), free_name(docs, "repeated")
    keep = keep.toDF(id_name, repeated)
    # The kept ids grow with the documents: both sides are shuffled at every size.
    named = docs.join(keep.hint("merge"), F.col(f"`{doc_id}`") == F.col(id_name)).drop(id_name)
    if not keep.filter(f"`{repeated}`").isEmpty():
        several = _one_of_each(named.filter(f"`{repeated}`"), doc_id, text)
        named = named.filter(f"NOT `{repeated}`").unionByName(several)
    named = named.drop(repeated)
    nameless = docs.filter(F.col(f"`{doc_id}`").isNull())
    if nameless.isEmpty():
        return named
    marked = nameless.withColumn(id_name, fingerprints(F.col(f"`{text}`").cast("binary"), shingle))
    lone = found.filter("doc_id IS NULL AND component_id IS NULL")
    roots = lone.select("fp").distinct().join(classes(found.select("fp").distinct(), max_bits), "fp", "left")
    chosen = roots.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("fp").alias(id_name)).select(id_name)
    lone_rows = _one_of_each(marked.join(chosen, id_name, "left_semi"), id_name, text)
    return named.unionByName(lone_rows.drop(id_name))


def _one_of_each(rows: DataFrame, key: str, text: str) -> DataFrame:
    """One row per key, of the least digest of its text. Only numbers are grouped, so a
    key of very many rows is dealt like any other."""
    row = free_name(rows, "row_number")
    kept = stored(rows.withColumn(row, F.monotonically_increasing_id()), "repeats")
    rank = F.struct(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")), F.col(row))
    first = kept.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.min_by(row, rank).alias("_first")).select("_first")
    return kept.join(first, F.col(row) == F.col("_first")).drop("_first", row)
