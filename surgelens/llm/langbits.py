"""Language identification by bit-sliced Bloom filters over character n-grams.

Every slot of the filter holds some bits for each language, so ``HASHES`` look-ups
and their conjunction give at once all languages that contain an n-gram. A language
has a slice of bits for every rate in ``BANDS``, down to "at all": an n-gram is in
those slices whose rate it reaches in the language's learned texts. So no language
is taken from an n-gram that it holds, but one that uses it often counts for more
than one that merely quotes it. A text's bits are counted per slice, the count that
chance hits explain (from how full the slice is) is taken off, and the language
with the largest sum decides; ties go to the language with more learned n-grams,
then to the first by name.

N-grams are four characters of the lower-cased text, each run of other than
letters being one space. Counting them is a group-by with sums made before the
shuffle. The number of slots follows from the most distinct n-grams that a language
has, so that at most a quarter of any slice is filled, whatever is learned. A table
larger than ``TABLE_BYTES`` is cut into parts by a hash of the n-gram; texts are
then counted part by part and the counts added, so no task holds more than a part.

A text that is null or has no letter is ``und`` with score 0; so is every text if
nothing was learned. The score is the best language's part of all corrected
counts. Rows with null language or text teach nothing. Repeated rows count each,
and null ids stay null. Texts of any length are read whole. An empty table gives no
rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import raw, small_batches, stored

HASHES = 3
# Rates that give a bit, per n-gram of a language; the last one is "at all".
BANDS = (1e-3, 1e-4, 1e-5, 0.0)
# Most of a slice that may be filled, and bytes of the table that a task may hold.
FILL = 0.25
TABLE_BYTES = 64 * 1024 * 1024
# N-grams that a task holds before it passes on their sums.
HELD = 4_000_000
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_PART_FACTOR = 0xD6E8FEB86659FD93


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() if not 0xD800 <= c < 0xE000 else False for c in range(1 << 16)])


def ngrams(text: str) -> tuple[np.ndarray, bool]:
    """64-bit numbers of the n-grams of a text, and whether it has a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    low = points < 1 << 16
    letter = _letters()[np.where(low, points, 0)]
    if not low.all():
        other = points[~low]
        known = {int(c): chr(c).isalpha() for c in np.unique(other)}
        letter[~low] = [known[int(c)] for c in other]
    if not letter.any():
        return np.zeros(0, np.uint64), False
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    body = np.where(letter, points & 0xFFFF, 32)[keep]
    ends = [32, 32] if letter[0] else [32]
    c = np.concatenate((ends, body, [32])).astype(np.uint64)
    return c[:-3] << np.uint64(48) | c[1:-2] << np.uint64(32) | c[2:-1] << np.uint64(16) | c[3:], True


def _high_bits(grams: np.ndarray, factor: int, n: int) -> np.ndarray:
    """A hash below ``n``, a power of two."""
    if n == 1:
        return np.zeros(len(grams), np.int64)
    return ((grams ^ (grams >> np.uint64(29))) * np.uint64(factor) >> np.uint64(65 - n.bit_length())).astype(np.int64)


def slots(grams: np.ndarray, n: int) -> list[np.ndarray]:
    return [_high_bits(grams, f, n) for f in _FACTORS[:HASHES]]


def slots_for(distinct: int) -> int:
    """Slots in which a slice with so many n-grams is filled to ``FILL`` at most."""
    least = max(4096, math.ceil(HASHES * distinct / -math.log(1 - FILL)))
    return 1 << (least - 1).bit_length()


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``docs`` (lang, text as bytes)."""

    def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        grams = np.concatenate([g for g, _ in parts])
        counts = np.concatenate([n for _, n in parts])
        order = np.argsort(grams, kind="stable")
        grams, counts = grams[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
        return grams[first], np.add.reduceat(counts, first)

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            grams, counts = summed(parts)
            for i in range(0, len(grams), 100_000):
                own = grams[i : i + 100_000].view(np.int64)
                values = [pa.array([lang] * len(own), pa.string()), pa.array(own), pa.array(counts[i : i + 100_000])]
                yield pa.RecordBatch.from_arrays(values, ["lang", "gram", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                found.setdefault(lang, []).append(ngrams(text.decode("utf-8", "replace"))[0])
            for lang, parts in found.items():
                grams = np.concatenate(parts)
                if len(grams):
                    held.setdefault(lang, []).append(summed([(grams, np.ones(len(grams), np.int64))]))
            size = sum(len(g) for parts in held.values() for g, _ in parts)
            if size > HELD:
                held = {lang: [summed(parts)] for lang, parts in held.items()}
                if sum(len(g) for parts in held.values() for g, _ in parts) > HELD // 2:
                    yield from rows(held)
                    held = {}
        yield from rows(held)

    counted = docs.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Part:
    """One part of the table, a row per word of bits, and how full each slice of it is."""

    def __init__(self, table: np.ndarray, n_bits: int):
        self.table, self.n_bits = table, n_bits
        width = 8 * table.itemsize
        self.fill = np.array([float(np.mean((table[i // width] >> table.dtype.type(i % width)) & table.dtype.type(1))) for i in range(n_bits)])
        self.chance = self.fill**HASHES

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """How many of the n-grams each slice contains, as far as the part tells."""
        at, width = slots(grams, self.table.shape[1]), 8 * self.table.itemsize
        found: list[int] = []
        for word in self.table:
            mask = word[at[0]]
            for own in at[1:]:
                mask &= word[own]
            bits = min(width, self.n_bits - len(found))
            found += [int(np.count_nonzero(mask & word.dtype.type(1 << b))) for b in range(bits)]
        return np.array(found)

    def counted(self, grams: np.ndarray) -> np.ndarray:
        """Hits without those that chance explains."""
        return (self.hits(grams) - len(grams) * self.chance) / np.maximum(1e-9, 1 - self.chance)


class Filter:
    """Languages with their learned n-grams, and the parts of the table: ``n_parts``
    of ``n_slots`` each, read one at a time."""

    def __init__(self, langs: list[str], weights: list[int], n_slots: int, n_parts: int, filled: DataFrame | None):
        self.langs, self.weights, self.n_slots, self.n_parts, self.filled = langs, weights, n_slots, n_parts, filled
        self.n_bits = len(langs) * len(BANDS)
        self.dtype, self.n_words = _layout(self.n_bits)

    def part(self, k: int) -> Part:
        """The rows of a part: at most one for each of its slots and words."""
        table = np.zeros((self.n_words, self.n_slots), self.dtype)
        if self.filled is not None:
            found = self.filled.filter(F.col("part") == k).select("word", "slot", "mask").toArrow()
            mask = found.column("mask").to_numpy().view(np.uint64).astype(self.dtype)
            table[found.column("word").to_numpy(), found.column("slot").to_numpy()] = mask
        return Part(table, self.n_bits)

    def of_part(self, grams: np.ndarray, k: int) -> np.ndarray:
        return grams[_high_bits(grams, _PART_FACTOR, self.n_parts) == k] if self.n_parts > 1 else grams

    def verdict(self, counted: np.ndarray | None) -> tuple[str, float]:
        """Language and score from the corrected counts of all slices (None: no letter)."""
        if counted is None or not self.langs:
            return "und", 0.0
        real = np.maximum(np.asarray(counted), 0).reshape(len(self.langs), len(BANDS)).sum(axis=1)
        best = max(range(len(self.langs)), key=lambda i: (real[i], self.weights[i], -i))
        whole = float(real.sum())
        return self.langs[best], float(real[best]) / whole if whole else 0.0


def _layout(n_bits: int) -> tuple[type, int]:
    """The smallest word that holds the bits, or as many of 64 as it takes."""
    for dtype in (np.uint8, np.uint16, np.uint32):
        if n_bits <= 8 * np.dtype(dtype).itemsize:
            return dtype, 1
    return np.uint64, max(1, -(-n_bits // 64))


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> Filter:
    """The filter over all rows of ``docs`` with a language and a text."""
    small_batches(docs.sparkSession)
    known = raw(docs, text, lang=lang).withColumn("lang", F.col("lang").cast("string")).dropna()
    return from_counts(stored(count_ngrams(known), "ngrams"))


def from_counts(counts: DataFrame) -> Filter:
    """The filter from a stored table of (lang, gram, n)."""
    sums = counts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("distinct")).collect()
    totals = {r["lang"]: r["n"] for r in sums}
    langs = sorted(totals)
    if not langs:
        return Filter([], [], 1, 1, None)
    dtype, n_words = _layout(len(langs) * len(BANDS))
    whole = slots_for(max(r["distinct"] for r in sums))
    n_parts = 1
    while whole // n_parts * n_words * np.dtype(dtype).itemsize > TABLE_BYTES:
        n_parts *= 2
    n_slots, width = whole // n_parts, 8 * np.dtype(dtype).itemsize
    number = F.create_map(*(F.lit(x) for i, name in enumerate(langs) for x in (name, i * len(BANDS))))
    total = F.create_map(*(F.lit(x) for name in langs for x in (name, float(totals[name]))))
    rated = counts.select("gram", number[F.col("lang")].alias("i"), (F.col("n") / total[F.col("lang")]).alias("rate"))
    bits = [F.when(F.col("rate") >= band, F.col("i") + b) for b, band in enumerate(BANDS)]
    each = rated.select("gram", F.explode(F.array_compact(F.array(*bits))).alias("i"))
    pairs = each.select("gram", F.expr(f"int(i div {width})").alias("word"), F.expr(f"shiftleft(1L, int(i % {width}))").alias("bit"))
    masks = pairs.groupBy("gram", "word").agg(F.bit_or("bit").alias("mask"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("gram").to_numpy().view(np.uint64)
            part = pa.array(np.tile(_high_bits(grams, _PART_FACTOR, n_parts), HASHES).astype(np.int32))
            slot = pa.array(np.concatenate(slots(grams, n_slots)).astype(np.int32))
            again = [pa.concat_arrays([batch.column(c)] * HASHES) for c in ("word", "mask")]
            yield pa.RecordBatch.from_arrays([part, slot, *again], ["part", "slot", "word", "mask"])

    filled = masks.mapInArrow(spread, "part int, slot int, word int, mask long")
    filled = stored(filled.groupBy("part", "word", "slot").agg(F.bit_or("mask").alias("mask")), "slots")
    return Filter(langs, [totals[name] for name in langs], n_slots, n_parts, filled)


def predict(docs: DataFrame, model: Filter, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row of ``docs``."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()
    out, rows = f"doc_id {kind}, lang_pred string, score double", raw(docs, text, doc_id=doc_id)
    langs = Filter(model.langs, model.weights, model.n_slots, model.n_parts, None)

    def answers(doc_ids: pa.Array, found: list[tuple[str, float]]) -> pa.RecordBatch:
        values = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
        return pa.RecordBatch.from_arrays([doc_ids, *values], ["doc_id", "lang_pred", "score"])

    def texts_of(batch: pa.RecordBatch) -> Iterator[np.ndarray | None]:
        for t in batch.column("text").to_pylist():
            grams, lettered = ngrams(t.decode("utf-8", "replace")) if t else (None, False)
            yield grams if lettered else None

    if model.n_parts == 1:
        part = model.part(0)

        def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield answers(batch.column("doc_id"), [langs.verdict(None if g is None else part.counted(g)) for g in texts_of(batch)])

        return rows.mapInArrow(decide, out)

    rows, parts = stored(rows.withColumn("row", F.monotonically_increasing_id()), "rows"), []
    for k in range(model.n_parts):

        def count(batches: Iterator[pa.RecordBatch], part=model.part(k), k=k) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counted = [None if g is None else part.counted(langs.of_part(g, k)).tolist() for g in texts_of(batch)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(counted, pa.list_(pa.float64()))], ["row", "counted"])

        parts.append(stored(rows.select("row", "text").mapInArrow(count, "row long, counted array<double>"), "counted"))
    each = [F.sum(F.get("counted", F.lit(i))) for i in range(model.n_bits)]
    sums = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.array(*each).alias("counted"), F.count("counted").alias("n"))
    joined = rows.select("row", "doc_id").join(sums, "row").select("doc_id", F.when(F.col("n") > 0, F.col("counted")).alias("counted"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield answers(batch.column("doc_id"), [langs.verdict(c) for c in batch.column("counted").to_pylist()])

    return joined.mapInArrow(settle, out)


def residue(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo: how rows are split into folds."""
    return F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).cast("binary")) % modulus
