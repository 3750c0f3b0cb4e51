"""Benchmark decontamination on a distributed positional inverted index.

The index is dealt out by document: a segment holds some megabytes of texts and,
for every test term, the sorted places where it stands there, as gaps. Segments
are stored as rows of one table, so a lost executor repeats only its own. Term
counts over all segments say which terms are rare. A search intersects, segment
by segment, the offset-adjusted lists of a window's terms from the rarest to the
most frequent. Exact matches are windows of ``window`` consecutive words (a
shorter item is one window). Proximity matches are items whose ``near_terms``
rarest distinct terms all stand within ``slop`` words of one place of the rarest.

Test items are taken in blocks of about ``BLOCK_WORDS`` words, the only thing
that is gathered and sent to the tasks; their number is not limited.

Null and empty texts have no words and no hits; items without words never match.
Repeated rows are searched one by one. An item without an id is searched for like
any other, so its words are hit; it is only left out of the lists of ids. Empty
tables give no rows, or rows without hits. Texts of any length are indexed whole,
and other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import free_name, plain_words, raw, small_batches, stored

# Words of test items that are searched for at once.
BLOCK_WORDS = 500_000
# Bytes of text in a segment of the index.
SEGMENT_BYTES = 8 * 1024 * 1024
# Unused places between two documents of a segment.
GAP = 64

_LISTS = {"doc_ids": None, "n_words": pa.int32(), "terms": pa.int32(), "counts": pa.int32()}


def build_index(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """The stored segments for ``terms``; ``docs`` has ``doc_id`` and ``text`` as bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    number = {t: i for i, t in enumerate(terms)}

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        ids: list = []
        words: list[int] = []
        lists: list[np.ndarray] = []
        size = 0
        id_type = None

        def segment() -> pa.RecordBatch:
            places, start = [], 0
            for own in lists:
                places.append(np.arange(start, start + len(own), dtype=np.int64))
                start += len(own) + GAP
            term = np.concatenate(lists) if lists else np.zeros(0, np.int32)
            place = np.concatenate(places) if places else np.zeros(0, np.int64)
            known = term >= 0
            term, place = term[known], place[known]
            order = np.argsort(term, kind="stable")
            term, place = term[order], place[order]
            present, first, counts = np.unique(term, return_index=True, return_counts=True)
            gaps = np.diff(place, prepend=0)
            gaps[first] = place[first]
            values = [
                pa.array([f"{part}-{made}"]),
                pa.array([ids], pa.list_(id_type)),
                pa.array([words], pa.list_(pa.int32())),
                pa.array([present.tolist()], pa.list_(pa.int32())),
                pa.array([counts.tolist()], pa.list_(pa.int32())),
                pa.array([gaps.astype("<u4").tobytes()], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(values, ["segment", *_LISTS, "gaps"])

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                own = plain_words(text)
                ids.append(doc)
                words.append(len(own))
                lists.append(np.fromiter(map(number.get, own, repeat(-1)), np.int32, len(own)))
                size += len(text or b"") + GAP
                if size >= SEGMENT_BYTES:
                    yield segment()
                    made += 1
                    ids, words, lists, size = [], [], [], 0
        if ids:
            yield segment()

    small_batches(docs.sparkSession)
    schema = f"segment string, doc_ids array<{kind}>, n_words array<int>, terms array<int>, counts array<int>, gaps binary"
    return stored(docs.select("doc_id", "text").mapInArrow(segments, schema), "positions")


def term_counts(index: DataFrame) -> dict[int, int]:
    """How often each term stands in the whole corpus: as many rows as a block has terms."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p")).select("p.terms", "p.counts")
    found = pairs.groupBy("terms").agg(F.sum(F.col("counts").cast("long")).alias("n")).collect()
    return {r["terms"]: r["n"] for r in found}


def _windows(items: list[tuple[str | None, list[int]]], window: int) -> dict[tuple[int, ...], set]:
    found: dict[tuple[int, ...], set] = defaultdict(set)
    for item, ids in items:
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            found[tuple(ids[i : i + window])].add(item)
    return found


def search(index: DataFrame, items: list[tuple[str, list[int]]], window: int, near_terms: int, slop: int) -> DataFrame:
    """A row per document of the index: covered spans of words, matching items, items near."""
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    counts = term_counts(index)
    rarity = lambda t: (counts[t], t)
    plan = []
    for ids, owners in sorted(_windows(items, window).items()):
        if all(t in counts for t in ids):
            order = sorted(range(len(ids)), key=lambda i: (counts[ids[i]], i))
            plan.append((ids, order, sorted(o for o in owners if o is not None)))
    near = []
    for item, ids in items:
        rare = sorted(set(ids), key=lambda t: rarity(t) if t in counts else (0, t))[:near_terms]
        if item is not None and rare and all(t in counts for t in rare):
            near.append((rare, item))

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield one(batch.slice(k, 1))

    def one(row: pa.RecordBatch) -> pa.RecordBatch:
        doc_ids = row.column("doc_ids").flatten()
        words = row.column("n_words").flatten().to_numpy()
        terms = row.column("terms").flatten().to_numpy()
        sizes = row.column("counts").flatten().to_numpy()
        gaps = np.frombuffer(row.column("gaps")[0].as_py(), "<u4").astype(np.int64)
        ends = np.cumsum(sizes)
        lists: dict[int, np.ndarray] = {}
        at = {int(t): (int(e - n), int(e)) for t, n, e in zip(terms, sizes, ends)}

        def places(term: int) -> np.ndarray:
            if term not in lists:
                lists[term] = np.cumsum(gaps[slice(*at[term])])
            return lists[term]

        def member(wanted: np.ndarray, term: int) -> np.ndarray:
            own = places(term)
            i = np.searchsorted(own, wanted)
            i[i == len(own)] = 0
            return own[i] == wanted

        bases = np.cumsum(words.astype(np.int64) + GAP) - words - GAP
        change = np.zeros(int(bases[-1] + words[-1]) + GAP + 1, np.int32)
        hits: dict[int, set[str]] = defaultdict(set)
        close: dict[int, set[str]] = defaultdict(set)
        for ids, order, owners in plan:
            if not all(ids[i] in at for i in order):
                continue
            starts = places(ids[order[0]]) - order[0]
            starts = starts[starts >= 0]
            for i in order[1:]:
                if not len(starts):
                    break
                starts = starts[member(starts + i, ids[i])]
            if len(starts):
                np.add.at(change, starts, 1)
                np.add.at(change, starts + len(ids), -1)
                for doc in np.unique(np.searchsorted(bases, starts, "right") - 1):
                    hits[int(doc)].update(owners)
        for rare, item in near:
            if not all(t in at for t in rare):
                continue
            centres = places(rare[0])
            for t in rare[1:]:
                own = places(t)
                i = np.searchsorted(own, centres - slop)
                centres = centres[(i < len(own)) & (own[np.minimum(i, len(own) - 1)] <= centres + slop)]
                if not len(centres):
                    break
            for doc in np.unique(np.searchsorted(bases, centres, "right") - 1):
                close[int(doc)].add(item)

        covered = np.concatenate(([0], (np.cumsum(change) > 0).view(np.int8), [0]))
        edges = np.flatnonzero(np.diff(covered))
        spans: dict[int, list] = defaultdict(list)
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            doc = int(np.searchsorted(bases, a, "right")) - 1
            spans[doc].append({"first": a - int(bases[doc]), "after": b - int(bases[doc])})
        n = len(words)
        span = pa.list_(pa.struct([("first", pa.int32()), ("after", pa.int32())]))
        text = pa.list_(pa.string())
        values = [
            pa.array([row.column("segment")[0].as_py()] * n, pa.string()),
            pa.array(range(n), pa.int32()),
            doc_ids,
            pa.array(words, pa.int32()),
            pa.array([spans.get(i, []) for i in range(n)], span),
            pa.array([sorted(hits.get(i, ())) for i in range(n)], text),
            pa.array([sorted(close.get(i, ())) for i in range(n)], text),
        ]
        return pa.RecordBatch.from_arrays(values, ["segment", "place", "doc_id", "n_words", "spans", "items", "near_items"])

    schema = (
        f"segment string, place int, doc_id {kind}, n_words int, spans array<struct<first:int,after:int>>,"
        " items array<string>, near_items array<string>"
    )
    return index.mapInArrow(match, schema)


def _blocks(items: DataFrame) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The test items, at most about ``BLOCK_WORDS`` words at a time."""
    letters = F.coalesce(F.length("text").cast("long"), F.lit(0))
    whole = items.agg(F.sum(letters)).first()[0] or 0
    n = -(-whole // (4 * BLOCK_WORDS)) or 1
    for k in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) if n > 1 else items
        yield [(r["item_id"], plain_words(bytes(r["text"]))) for r in own.collect() if r["text"] is not None]


def _merged(parts: DataFrame) -> DataFrame:
    """The rows of several blocks as one per document: spans united, items together."""
    key = ["segment", "place"]
    joined = parts.groupBy(*key).agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_words").alias("n_words"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("all"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("near_items")))).alias("near_items"),
    )
    united = F.expr(
        "aggregate(all, cast(array() AS array<struct<first:int,after:int>>), (s, x) -> CASE"
        " WHEN size(s) > 0 AND x.first <= element_at(s, -1).after THEN concat(slice(s, 1, size(s) - 1),"
        " array(named_struct('first', element_at(s, -1).first, 'after', greatest(element_at(s, -1).after, x.after))))"
        " ELSE concat(s, array(x)) END)"
    )
    return joined.withColumn("spans", united).select(*key, "doc_id", "n_words", "spans", "items", "near_items")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    near_terms: int = 4,
    slop: int = 20,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, spans, items, near_items."""
    own = raw(docs, text, doc_id=doc_id)
    items = raw(benchmark, item_text, item_id=item_id).withColumn("item_id", F.col("item_id").cast("string"))
    parts = None
    for block in _blocks(items):
        terms = sorted({w for _, words in block for w in words})
        number = {t: i for i, t in enumerate(terms)}
        index = build_index(own, terms)
        found = search(index, [(i, [number[w] for w in words]) for i, words in block], window, near_terms, slop)
        parts = found if parts is None else _merged(stored(parts.unionAll(found), "matches"))
    return parts.drop("segment", "place")


def uncontaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 10) -> DataFrame:
    """``docs`` without the rows that hold a passage of a test item.

    Only the ids of such documents are joined back, and a row goes if its own
    text was hit: rows that share an id but not the text are told apart by a hash.
    """
    digest = lambda: F.xxhash64(F.col(f"`{text}`"))
    name, hashed = free_name(docs, "hit_id"), free_name(docs, "hit_text")
    own = docs.select(F.struct(F.col(f"`{doc_id}`").alias("id"), digest().alias("text_hash")).alias("row"), F.col(f"`{text}`").alias("text"))
    found = contamination(own, benchmark, doc_id="row", window=window).filter(F.size("spans") > 0)
    hit = stored(found.select("doc_id.id", "doc_id.text_hash").distinct(), "hits").toDF(name, hashed)
    match = F.col(f"`{doc_id}`").eqNullSafe(F.col(name)) & (digest() == F.col(hashed))
    return docs.join(hit, match, "left_anti")
