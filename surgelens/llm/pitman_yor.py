"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every context is a restaurant whose tables send their dishes, as customers, to
the parent restaurant that all contexts share; the parent's own tables are laid
from a uniform base over the learned tokens and one for all others. A context is
the word before, or a text's start, and every context has a restaurant of its own.

The most frequent words are the head, all others are rare. Tokens are dealt to
buckets: a rare token by itself, its home; a head token with its context, in the
context's home if that is rare. So a bucket has all that a rare token needs, and no
bucket grows with a head word's frequency. A bucket is one row of a bucketed table,
packed in arrays, and holds about ``BUCKET_TOKENS`` tokens; the number of buckets
grows with the input. Rare contexts of rare tokens lie in several buckets. What
these have in them is summed by context once a round, and listed for the buckets
it came from, which don't move. The chain begins with a seating close to its law; a
round lifts half the customers of every restaurant by Gibbs steps, seats them
anew by the Chinese restaurant process, and goes on from the seating the round
before left. A pair's new and closed tables are customers that enter and leave
the parent's seating. Seatings are kept as table sizes, so they grow with tables,
not with customers. Buckets take the number of tables in each context, and the
parent's counts, from the round before; the sums over start and head words for the
next round travel as packed blocks, of which there is a fixed number. Predictive probabilities
of the last ``SAMPLES`` rounds are averaged, and their logarithms summed by
document. Draws are seeded by round and bucket: a lost task repeats them exactly.

Discounts follow from how many pairs, and tokens, have one and two customers.

Texts are lower-cased (A-Z); tokens are words between white space and a final
end. Null and empty texts are the end alone. Repeated rows are scored, and
learned from, one by one. If nothing is learned, every token is the unknown one.
Null ids stay null. Texts of any length are scored whole; a very long one ends
its chunk. An empty table gives no rows; other columns, whatever their
names, are not read. Equal counts need no order, so ties change nothing.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import BATCH_ROWS, raw, small_batches, stored
from surgelens.session import scratch_path

HEAD = 32_768
START = HEAD  # the number of a text's start among contexts
RARE = HEAD + 1  # rare contexts of a bucket are numbered from here on
END = 0  # the number of the end token; head words follow
BUCKET_TOKENS = 1_200_000
CHUNK_BYTES = 4 * 1024 * 1024
CHUNK_DOCS = 30_000
WORDS_HELD = 300_000
ROUNDS = 3
SAMPLES = 2
STRENGTH = 1.0  # of all restaurants
# Customers of a restaurant up to which they are moved one by one.
SINGLY = 8
# One customer in so many of larger restaurants is lifted at a time.
SHARE = 16

_TRAIN = 1 << 15
_DOC_BITS = 15


# ---------------------------------------------------------------- seating


@dataclass
class Seating:
    """Tables of many independent restaurants of one dish each: the restaurant of
    every table, rising, and its customers. The state of the chain: it grows with
    tables, not with customers."""

    owner: np.ndarray
    size: np.ndarray

    def tables(self, n: int) -> np.ndarray:
        return np.bincount(self.owner, minlength=n).astype(np.int64)


def _order(key: np.ndarray) -> np.ndarray:
    """Places of the keys, none negative, in stable order. Numbers sort faster than
    places by number, so each key is sorted with its place in the low bits, if both fit."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)) >> 63 - bits:
        return np.argsort(key, kind="stable")
    key = key.astype(np.int64)
    key <<= bits
    key |= np.arange(len(key))
    key.sort()
    key &= (1 << bits) - 1
    return key


def _ranked(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each restaurant's tables begin, and how many there are."""
    tables = np.bincount(owner, minlength=n)
    return np.cumsum(tables) - tables, tables


def _dealt(rng, owner: np.ndarray, weight: np.ndarray, n: np.ndarray, draw) -> np.ndarray:
    """Deal ``n`` of each restaurant over its tables, one table of each after the
    other; ``draw`` gives a table's part of what is left."""
    found = np.zeros(len(owner), np.int64)
    first, tables = _ranked(owner, len(n))
    rest = np.bincount(owner, weight, len(n))
    left = n.astype(np.int64)
    who = np.flatnonzero((tables > 0) & (left > 0))
    j = 0
    while len(who):
        at = first[who] + j
        part = draw(rng, left[who], weight[at], rest[who])
        found[at] = part
        left[who] -= part
        rest[who] -= weight[at]
        j += 1
        who = who[(tables[who] > j) & (left[who] > 0)]
    return found


def _by_weight(rng, left, weight, rest):
    return rng.binomial(left, np.clip(weight / np.maximum(rest, 1e-300), 0.0, 1.0))


def _without_return(rng, left, weight, rest):
    good, bad = weight.astype(np.int64), np.maximum(np.rint(rest - weight), 0).astype(np.int64)
    small = (good < 10**8) & (bad < 10**8)
    found = np.empty(len(left), np.int64)
    found[small] = rng.hypergeometric(good[small], bad[small], left[small])
    # Numpy's law ends at 10**9; so many customers are as good as drawn with return.
    wide = ~small
    drawn = rng.binomial(left[wide], good[wide] / (good[wide] + bad[wide]))
    found[wide] = np.clip(drawn, left[wide] - bad[wide], good[wide])
    return found


def seat(rng, s: Seating, more: np.ndarray, weight: np.ndarray, discount: float) -> Seating:
    """Seat ``more`` customers of each restaurant, who see the tables of ``s``: an old
    one is chosen by its customers less the discount, a new one by ``weight``."""
    n = len(more)
    held = s.size > 0
    owner, size = s.owner[held], s.size[held]
    by = size - discount
    old = np.bincount(owner, by, n)
    fresh = rng.binomial(more, weight / (weight + old))
    back = more - fresh
    part = _dealt(rng, owner, by, back, _by_weight)
    size = size + part
    # What rounding left over joins the first table.
    short = back - np.bincount(owner, part, n).astype(np.int64)
    lost = np.flatnonzero(short)
    if len(lost):
        size[_ranked(owner, n)[0][lost]] += short[lost]
    if not fresh.any():
        return Seating(owner, size)
    owner = np.concatenate((owner, np.repeat(np.arange(n), fresh)))
    size = np.concatenate((size, np.ones(int(fresh.sum()), np.int64)))
    order = _order(owner)
    return Seating(owner[order], size[order])


def _stable_sizes(rng, most: np.ndarray, discount: float) -> np.ndarray:
    """Sizes, ``most`` at most, of tables that few of many customers sit at: size
    ``k`` is left behind with chance ``1 - discount / k``."""
    beyond = np.cumprod(1 - discount / np.arange(1, 65))
    over = beyond[np.minimum(most, 64) - 1] * (np.maximum(most, 64) / 64.0) ** -discount
    u = 1 - rng.random(len(most)) * (1 - over)
    size = 1 + np.searchsorted(-beyond, -u, "left")
    far = size > 64
    size[far] = 65 * (u[far] / beyond[-1]) ** (-1 / discount)
    return np.minimum(size, most)


def opened(rng, count: np.ndarray, weight: np.ndarray, discount: float) -> Seating:
    """A first seating close to where the chain rests. Given all customers of a
    restaurant, the tables besides the largest are about Poisson in number, and the
    largest has whom the others leave. (Customers seated in turn would open several
    times as many tables, and large restaurants forget that slowly.)"""
    own, discount = np.flatnonzero(count), max(discount, 0.05)
    crowd = count[own].astype(np.int64)
    # Chance of two tables against one, over the weight of a new table.
    pole = abs(2 * discount - 1) < 1e-9
    near = 0.0 if pole else math.gamma(1 - discount) / math.gamma(1 - 2 * discount)
    second = (1 - near * (np.maximum(crowd, 2) - 1.5 * discount) ** -discount) / discount
    more = np.minimum(rng.poisson(weight[own] * np.maximum(second, 0.0)), crowd - 1)
    owner = np.repeat(np.arange(len(own)), more)
    # The largest table is the one with the rest, so no other has more than half.
    size = _stable_sizes(rng, np.maximum(crowd[owner] // 2, 1), discount)
    taken = np.cumsum(np.minimum(size, crowd[owner]))
    before = np.concatenate(([0], np.cumsum(more)))
    start = np.concatenate(([0], taken))[before[:-1]]
    # Tables that would leave nobody for the largest one aren't opened.
    fits = taken - start[owner] < crowd[owner]
    owner, size = owner[fits], size[fits]
    rest = crowd - np.bincount(owner, size, len(own)).astype(np.int64)
    owner = np.concatenate((np.arange(len(own)), owner))
    size = np.concatenate((rest, size))
    order = _order(owner)
    return Seating(own[owner[order]], size[order])


def follow(rng, s: Seating, before: np.ndarray, after: np.ndarray, weight: np.ndarray, discount: float) -> Seating:
    """The seating when restaurants lose customers, any of them, or gain some."""
    gone = _dealt(rng, s.owner, s.size.astype(np.float64), np.maximum(before - after, 0), _without_return)
    return seat(rng, Seating(s.owner, s.size - gone), np.maximum(after - before, 0), weight, discount)


def _moved_singly(rng, size: np.ndarray, weight: np.ndarray, discount: float) -> None:
    """Gibbs steps for half the customers, one after the other, of restaurants with
    equally many; ``size``: a row each, as wide as there are customers."""
    m, c = size.shape
    row = np.arange(m)
    for _ in range(-(-c // 2)):
        drawn = (rng.random(m) * c).astype(np.int64)
        size[row, (np.cumsum(size, 1) <= drawn[:, None]).sum(1)] -= 1
        held = size > 0
        by = np.cumsum(np.where(held, size - discount, 0.0), 1)
        mark = rng.random(m) * (weight + by[:, -1])
        # Beyond all tables in use: the first free place.
        chosen = np.where(mark < by[:, -1], (by <= mark[:, None]).sum(1), np.argmin(held, 1))
        size[row, chosen] += 1


def sweep(rng, s: Seating, count: np.ndarray, weight: np.ndarray, discount: float) -> Seating:
    """Gibbs steps for half the customers of every restaurant. Up to ``SINGLY``
    customers are lifted one by one, given all others: the exact chain. Larger
    ones lift one in ``SHARE`` at random, as often as makes a half; those lifted
    together see only the tables of those that stayed, which costs up to 4 % in
    the mean number of tables."""
    n = len(count)
    owners, sizes = [], []
    first, tables = _ranked(s.owner, n)
    rank = np.arange(len(s.owner)) - first[s.owner]
    crowd = count[s.owner]
    for c in range(1, SINGLY + 1):
        own = np.flatnonzero(count == c)
        if not len(own):
            continue
        at = np.flatnonzero(crowd == c)
        row = np.searchsorted(own, s.owner[at])
        size = np.zeros((len(own), c), np.int64)
        size[row, rank[at]] = s.size[at]
        if c > 1:
            _moved_singly(rng, size, weight[own], discount)
        row, column = np.nonzero(size)
        owners.append(own[row])
        sizes.append(size[row, column])
    own = np.flatnonzero(count > SINGLY)
    if len(own):
        at = np.flatnonzero(crowd > SINGLY)
        big = Seating(np.searchsorted(own, s.owner[at]), s.size[at])
        for _ in range(SHARE // 2):
            lifted = rng.binomial(big.size, 1 / SHARE)
            more = np.bincount(big.owner, lifted, len(own)).astype(np.int64)
            big = seat(rng, Seating(big.owner, big.size - lifted), more, weight[own], discount)
        owners.append(own[big.owner])
        sizes.append(big.size)
    if not owners:
        return s
    owner, size = np.concatenate(owners), np.concatenate(sizes)
    order = _order(owner)
    return Seating(owner[order], size[order])


# ---------------------------------------------------------------- packing


def _words(text: pa.Array) -> pa.Array:
    """Lists of the lower-cased words of texts; white space around a text leaves empty
    ones. As bytes: Arrow's functions for ASCII leave all other bytes alone."""
    return pc.ascii_split_whitespace(pc.ascii_lower(text.cast(pa.binary()).view(pa.string())))


def head_words(docs: DataFrame) -> list[bytes]:
    """The most frequent words of the learned texts, ``HEAD - 1`` at most: all words
    above a count, which a histogram of counts gives."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.Table] = []

        def rows() -> Iterator[pa.RecordBatch]:
            for part in parts:
                for own in part.to_batches(max_chunksize=BATCH_ROWS):
                    yield pa.RecordBatch.from_arrays([own.column("word").view(pa.binary()), own.column("n")], ["word", "n"])

        for batch in batches:
            found = pc.value_counts(_words(batch.column("text")).flatten())
            found = pa.table({"word": found.field(0), "n": found.field(1)})
            parts.append(found.filter(pc.not_equal(found["word"], "")))
            if sum(map(len, parts)) > WORDS_HELD:
                whole = pa.concat_tables(parts).group_by("word", use_threads=False).aggregate([("n", "sum")])
                parts = [whole.select(["word", "n_sum"]).rename_columns(["word", "n"])]
                if len(whole) > WORDS_HELD:
                    yield from rows()
                    parts = []
        yield from rows()
        pa.default_memory_pool().release_unused()

    counted = docs.filter("train").select("text").mapInArrow(count, "word binary, n long")
    words = stored(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    step = F.floor(F.log2("n") * 16)
    histogram = words.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    taken, least = 0, None
    for r in histogram:
        if taken + r["count"] > HEAD - 1:
            break
        taken, least = taken + r["count"], r["step"]
    if least is None:
        return []
    return sorted(words.filter(step >= least).select("word").toArrow().column("word").to_pylist())


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return a ^ (a >> np.uint64(29))


def packed(docs: DataFrame, head: list[bytes], buckets: int) -> DataFrame:
    """A chunk's documents, as a row with a number below 0 for its bucket, and a
    chunk's tokens of each bucket."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        squeeze = zstandard.ZstdCompressor(level=1)
        ids: list = []
        train: list[bool] = []
        texts: list[pa.Array] = []
        size = 0
        id_type = None
        known = pa.array(head, pa.binary())

        def rows(bucket, blob, doc_ids, trains, ns) -> pa.RecordBatch:
            values = [
                pa.array([f"{part}-{made}"] * len(bucket), pa.string()),
                pa.array(bucket, pa.int32()),
                pa.array(blob, pa.binary()),
                pa.array(doc_ids, pa.list_(id_type)),
                pa.array(trains, pa.list_(pa.bool_())),
                pa.array(ns, pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(values, ["chunk", "bucket", "blob", "doc_ids", "train", "n_tokens"])

        def chunk() -> Iterator[pa.RecordBatch]:
            words = _words(pa.concat_arrays(texts))
            lengths = pc.list_value_length(words).fill_null(0).to_numpy()
            coded = words.flatten().dictionary_encode()
            code, names = coded.indices.to_numpy(), coded.dictionary.view(pa.binary())
            number = pc.index_in(names, value_set=known).fill_null(-1).to_numpy() + 1
            blank = pc.equal(names, b"").to_numpy(zero_copy_only=False)
            tail = np.flatnonzero((number == 0) & ~blank)
            number = number.astype(np.int64)
            number[tail] = HEAD + np.arange(len(tail))
            rare = names.take(pa.array(tail)).to_numpy(zero_copy_only=False)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, rare), np.uint64, len(tail))
            real = ~blank[code]
            lengths = np.bincount(np.repeat(np.arange(len(ids)), lengths)[real], minlength=len(ids)) + 1
            word = np.full(lengths.sum(), END)
            inner = np.ones(len(word), bool)
            inner[np.cumsum(lengths) - 1] = False
            word[inner] = number[code[real]]
            doc = np.repeat(np.arange(len(ids)), lengths)
            before = np.empty_like(word)
            before[1:] = np.where(word[:-1] < HEAD, word[:-1], word[:-1] - HEAD + RARE)
            before[np.cumsum(lengths) - lengths] = START
            bits = (RARE + len(tail)).bit_length()
            if 2 * bits + _DOC_BITS < 64:
                key = np.sort(word << bits + _DOC_BITS | before << _DOC_BITS | doc)
                word, context, doc = key >> bits + _DOC_BITS, key >> _DOC_BITS & (1 << bits) - 1, key & (1 << _DOC_BITS) - 1
            else:
                order = np.lexsort((doc, before, word))
                word, context, doc = word[order], before[order], doc[order]
            new = (np.diff(word) != 0) | (np.diff(context) != 0) | (np.diff(doc) != 0)
            first = np.flatnonzero(np.concatenate(([True], new)))
            times = np.diff(np.append(first, len(word)))
            # A count has one byte; larger ones take several rows.
            times_of = -(-times // 255)
            word, context, doc = (np.repeat(v[first], times_of) for v in (word, context, doc))
            last = np.cumsum(times_of) - 1
            cut = np.full(len(word), 255, np.int64)
            cut[last] = times - 255 * (times_of - 1)
            doc = doc | np.where(np.array(train)[doc], _TRAIN, 0)
            is_head, is_rare = word < HEAD, context >= RARE
            own = np.where(is_head, word << 16 | context, 0).astype(np.uint64)
            own[is_rare] = hashes[context[is_rare] - RARE]
            own[~is_head] = hashes[word[~is_head] - HEAD]
            mark = np.minimum(context, RARE)
            bucket = (_mixed(own) % np.uint64(buckets)).astype(np.int64)
            order = _order(bucket)
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
            found, blobs = [], []
            for b in np.flatnonzero(np.diff(edges)):
                i = order[edges[b] : edges[b + 1]]
                h = i[is_head[i]]
                t = i[~is_head[i]]
                local, rows_of = np.unique(word[t], return_counts=True)
                rare_h, rare_t = h[is_rare[h]], t[is_rare[t]]
                parts = [
                    np.array([len(h), len(local), len(t), len(rare_h), len(rare_t)], "<u4"),
                    word[h].astype("<u2"),
                    mark[h].astype("<u2"),
                    doc[h].astype("<u2"),
                    cut[h].astype("u1"),
                    hashes[local - HEAD].astype("<u8"),
                    rows_of.astype("<u4"),
                    mark[t].astype("<u2"),
                    doc[t].astype("<u2"),
                    cut[t].astype("u1"),
                    hashes[context[rare_h] - RARE].astype("<u8"),
                    hashes[context[rare_t] - RARE].astype("<u8"),
                ]
                found.append(int(b))
                blobs.append(squeeze.compress(b"".join(p.tobytes() for p in parts)))
            spread = xxhash.xxh32_intdigest(f"{part}-{made}") % buckets
            yield rows([-1 - spread], [None], [ids], [train], [lengths.tolist()])
            for i in range(0, len(found), 64):
                n = len(found[i : i + 64])
                yield rows(found[i : i + 64], blobs[i : i + 64], [None] * n, [None] * n, [None] * n)

        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            text = batch.column("text")
            sizes = pc.binary_length(text).fill_null(0).to_pylist()
            first = 0
            for i, (doc_id, learned) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "train")))):
                ids.append(doc_id)
                train.append(learned)
                size += sizes[i] + 1
                if size >= CHUNK_BYTES or len(ids) >= CHUNK_DOCS:
                    texts.append(text[first : i + 1])
                    yield from chunk()
                    made += 1
                    first = i + 1
                    ids, train, texts, size = [], [], [], 0
            if first < len(text):
                texts.append(text[first:])
        if ids:
            yield from chunk()
        pa.default_memory_pool().release_unused()

    schema = (
        f"chunk string, bucket int, blob binary, doc_ids array<{kind}>, train array<boolean>,"
        " n_tokens array<bigint>"
    )
    return docs.select("doc_id", "train", "text").mapInArrow(pack, schema)


_TYPES = {"word": "<u4", "context": "<u4", "count": "<u4", "rows": "<u4", "chunk": "<u4", "doc": "<u2", "times": "u1", "keys": "<u8"}


def _numbered(names: np.ndarray, words: np.ndarray, contexts: np.ndarray, word_times: np.ndarray, times: np.ndarray):
    """Numbers of a bucket's rare contexts, and the hashes of those, numbered first and
    rising, that may have places in other buckets too. ``contexts`` has the hash of every
    place with a rare context, ``times`` its weight. A context that is at home (``names``:
    the rare tokens; ``words``: the token of every place, ``word_times`` its weight) and
    precedes as many places here as it has itself has none elsewhere."""
    keys, at = np.unique(contexts, return_inverse=True)
    if not len(keys):
        return at, keys
    here = np.bincount(at, times, len(keys))
    occurs = np.append(np.bincount(words, word_times, len(names)), np.inf)
    home = np.searchsorted(names, keys)
    home[~np.isin(keys, names)] = len(names)
    apart = occurs[home] > here
    number = np.empty(len(keys), np.int64)
    number[np.argsort(~apart, kind="stable")] = np.arange(len(keys))
    return number[at], keys[apart]


def bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """A row for each bucket: its pairs (token, context), how often each was learned,
    and all their places, sorted by pair, each array squeezed. Rare tokens are numbered from ``HEAD`` on, rare
    contexts from ``RARE`` on, first those with ``keys``: they may be in other buckets too.
    The rows of chunks' documents pass through."""
    lists = {c: rows.schema[c].dataType.simpleString() for c in ("doc_ids", "train", "n_tokens")}

    def merged(bucket: int, chunks: list[str], blobs: list[bytes]) -> pa.RecordBatch:
        parts: dict[str, list[np.ndarray]] = {c: [] for c in ("word", "context", "doc", "times", "chunk")}
        keys, key_rows, tails, head_contexts, tail_contexts = [], [], [], [], []
        for c, squeezed in enumerate(blobs):
            blob = zstandard.decompress(squeezed)
            h, k, t, rare_h, rare_t = np.frombuffer(blob, "<u4", 5).tolist()
            at = 20

            def take(kind: str, n: int) -> np.ndarray:
                nonlocal at
                found = np.frombuffer(blob, kind, n, at)
                at += found.nbytes
                return found

            own = [take("<u2", h), take("<u2", h), take("<u2", h), take("u1", h)]
            keys.append(take("<u8", k))
            key_rows.append(take("<u4", k))
            tails.append([take("<u2", t), take("<u2", t), take("u1", t)])
            head_contexts.append(take("<u8", rare_h))
            tail_contexts.append(take("<u8", rare_t))
            for name, values in zip(("word", "context", "doc", "times"), own):
                parts[name].append(values.astype(_TYPES[name]))
            parts["chunk"].append(np.full(h, c, np.uint32))
        names, local = np.unique(np.concatenate(keys), return_inverse=True)
        parts["word"].append((HEAD + np.repeat(local, np.concatenate(key_rows))).astype(np.uint32))
        for c, (context, doc, times) in enumerate(tails):
            parts["chunk"].append(np.full(len(context), c, np.uint32))
            for name, values in (("context", context), ("doc", doc), ("times", times)):
                parts[name].append(values.astype(_TYPES[name]))
        flat = {name: np.concatenate(parts.pop(name)) for name in list(parts)}
        rare, away = flat["word"] >= HEAD, np.flatnonzero(flat["context"] == RARE)
        contexts = np.concatenate(head_contexts + tail_contexts)
        number, shared = _numbered(names, flat["word"][rare] - HEAD, contexts, flat["times"][rare], flat["times"][away])
        flat["context"][away] += number.astype(np.uint32)
        bits = int(flat["context"].max(initial=0)).bit_length()
        pair = flat["word"].astype(np.int64) << bits | flat["context"]
        del flat["word"], flat["context"]
        order = _order(pair)
        pair = pair[order]
        first = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        learned = np.where(flat["doc"] & _TRAIN, flat["times"], np.uint32(0))[order]
        columns = {
            "word": pair[first] >> bits,
            "context": pair[first] & (1 << bits) - 1,
            "count": np.add.reduceat(learned, first),
            "rows": np.diff(np.append(first, len(pair))),
            "chunk": flat["chunk"][order],
            "doc": (flat["doc"] & (_TRAIN - 1))[order],
            "times": flat["times"][order],
            "keys": shared,
        }
        squeeze = zstandard.ZstdCompressor(level=3)
        values = [pa.array([bucket], pa.int32()), pa.array([chunks], pa.list_(pa.string()))]
        values += [pa.array([squeeze.compress(columns[c].astype(k).tobytes())], pa.binary()) for c, k in _TYPES.items()]
        values += [pa.nulls(1, t) for t in list_types]
        return pa.RecordBatch.from_arrays(values, ["bucket", "chunks", *_TYPES, *lists])

    def passed(row: pa.RecordBatch) -> pa.RecordBatch:
        chunk = pa.array([[row.column("chunk")[0].as_py()]], pa.list_(pa.string()))
        values = [row.column("bucket"), chunk, *(pa.nulls(1, pa.binary()) for _ in _TYPES), *(row.column(c) for c in lists)]
        return pa.RecordBatch.from_arrays(values, ["bucket", "chunks", *_TYPES, *lists])

    list_types: list[pa.DataType] = []

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, chunks, blobs = None, [], []
        for batch in batches:
            list_types[:] = [batch.schema.field(c).type for c in lists]
            named = (batch.column(c).to_pylist() for c in ("bucket", "chunk", "blob"))
            for i, (bucket, chunk, blob) in enumerate(zip(*named)):
                if blob is None:
                    yield passed(batch.slice(i, 1))
                    continue
                if bucket != current and blobs:
                    yield merged(current, chunks, blobs)
                    chunks, blobs = [], []
                current = bucket
                chunks.append(chunk)
                blobs.append(blob)
        if blobs:
            yield merged(current, chunks, blobs)

    dealt = rows.repartition(buckets, "bucket")
    schema = "bucket int, chunks array<string>, " + ", ".join(f"{c} binary" for c in _TYPES)
    schema += "".join(f", {c} {t}" for c, t in lists.items())
    return dealt.sortWithinPartitions("bucket", "chunk").mapInArrow(merge, schema)


def dealt_table(rows: DataFrame, buckets: int, name: str = "buckets") -> DataFrame:
    """The rows written as a table that Spark knows to be dealt by ``bucket``: joins of
    such tables move no row."""
    spark, table = rows.sparkSession, f"op3_{name}_{uuid.uuid4().hex}"
    writer = rows.write.format("parquet").option("compression", "zstd").bucketBy(buckets, "bucket")
    # A task has one bucket, or few: open files take less than a sort of such long rows.
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "4")
    try:
        writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    finally:
        spark.conf.set(writers, before)
    return spark.table(table)


# ---------------------------------------------------------------- rounds


@dataclass
class Counts:
    """What buckets share: customers and tables, by context, by head word, in all."""

    customers: np.ndarray  # by context that isn't rare, fixed
    learned: np.ndarray  # head words, fixed: how often they were learned
    distinct: int  # learned tokens
    whole: int  # tokens learned from
    discount: float
    parent_discount: float
    tables: np.ndarray  # by context that isn't rare
    sent: np.ndarray  # head words: customers in the parent restaurant
    laid: np.ndarray  # head words: tables there
    all_sent: int
    all_laid: int

    @property
    def base(self) -> float:
        return 1.0 / (self.distinct + 1)

    def parent(self, sent: np.ndarray, laid: np.ndarray) -> np.ndarray:
        rest = (STRENGTH + self.parent_discount * self.all_laid) * self.base
        return (sent - self.parent_discount * laid + rest) / (STRENGTH + self.all_sent)

    def new_parent_table(self) -> float:
        return (STRENGTH + self.parent_discount * self.all_laid) * self.base


@dataclass
class Bucket:
    number: int
    word: np.ndarray
    context: np.ndarray
    count: np.ndarray
    # Hashes of the rare contexts that may be in other buckets; which of them are and
    # have a pair, anywhere, whose tables can change; their customers in other buckets,
    # and their tables there after each round.
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    moving: np.ndarray | None = None
    guests: np.ndarray | None = None
    elsewhere: list[np.ndarray] = field(default_factory=list)
    # The seatings that rounds left, packed; and those of the last round worked out.
    seatings: list[bytes] = field(default_factory=list)
    left: tuple[Seating, Seating] | None = None
    tail: int = field(init=False)
    rare: int = field(init=False)

    def __post_init__(self):
        self.tail = max(0, int(self.word.max(initial=0)) + 1 - HEAD)
        self.rare = max(0, int(self.context.max(initial=0)) + 1 - RARE)

    def by_rare(self, values: np.ndarray, other: np.ndarray | None = None) -> np.ndarray:
        """Sums over the pairs of each rare context, here and in other buckets."""
        own = self.context >= RARE
        sums = np.bincount(self.context[own] - RARE, values[own], self.rare).astype(np.int64)
        if other is not None:
            sums[: len(other)] += other
        return sums

    def by_context(self, values: np.ndarray) -> np.ndarray:
        """Sums over the pairs of each context that isn't rare."""
        own = self.context < RARE
        return np.bincount(self.context[own], values[own], START + 1)

    def tables(self, g: Counts, turn: int, found: np.ndarray) -> np.ndarray:
        """Tables of every context after a round, ``found`` of each pair here."""
        return np.concatenate((g.tables, self.by_rare(found, self.elsewhere[turn] if self.elsewhere else None)))

    def by_tail(self, values: np.ndarray) -> np.ndarray:
        """Sums over the pairs of each rare token."""
        rare = self.word >= HEAD
        return np.bincount(self.word[rare] - HEAD, values[rare], self.tail).astype(np.int64)

    def by_head(self, values: np.ndarray) -> np.ndarray:
        common = self.word < HEAD
        return np.bincount(self.word[common], values[common], HEAD)

    def prior(self, g: Counts, sent: np.ndarray, laid: np.ndarray) -> np.ndarray:
        """The parent's probability of each pair's token."""
        return np.concatenate((g.parent(g.sent, g.laid), g.parent(sent, laid)))[self.word]

    def chain(self, rounds: list[Counts]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """After each round: tables of every pair, and the rare tokens' customers and
        tables in the parent. A round goes on from the seating that the one before
        left. Rounds whose ``seatings`` are kept are read, not worked out again."""
        many = np.flatnonzero(self.count > 1)
        count = self.count[many].astype(np.int64)
        found = (self.count > 0).astype(np.int64)
        sent = self.by_tail(found)
        laid = (sent > 0).astype(np.int64)
        s = above = None
        for turn, g in enumerate(rounds, 1):
            kept = turn <= len(self.seatings)
            rng = np.random.default_rng([turn, self.number])
            if kept:
                s, above = _unpacked(self.seatings[turn - 1], len(many), self.tail)
            else:
                opening = STRENGTH + g.discount * self.tables(g, turn - 1, found)[self.context[many]]
                opening = opening * self.prior(g, sent, laid)[many]
                s = sweep(rng, s or opened(rng, count, opening, g.discount), count, opening, g.discount)
            found = found.copy()
            found[many] = s.tables(len(many))
            before, sent = sent, self.by_tail(found)
            if not kept:
                weight = np.full(self.tail, g.new_parent_table())
                if above is None:
                    above = opened(rng, sent, weight, g.parent_discount)
                else:
                    above = follow(rng, above, before, sent, weight, g.parent_discount)
                above = sweep(rng, above, sent, weight, g.parent_discount)
            laid = above.tables(self.tail)
            self.left = s, above
            yield found, sent, laid


def _packed(seatings: tuple[Seating, Seating], pairs: int, tail: int) -> bytes:
    """The seatings of the pairs with several customers, and of the rare tokens in the
    parent: tables of each restaurant, then the customers of each table."""
    values = (v for s, n in zip(seatings, (pairs, tail)) for v in (s.tables(n), s.size))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(v.astype("<u4").tobytes() for v in values))


def _unpacked(blob: bytes, pairs: int, tail: int) -> Iterator[Seating]:
    values, at = np.frombuffer(zstandard.decompress(blob), "<u4").astype(np.int64), 0
    for n in (pairs, tail):
        owner = np.repeat(np.arange(n), values[at : at + n])
        yield Seating(owner, values[at + n : at + n + len(owner)])
        at += n + len(owner)


def _column(row: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(row.column(name)[0].as_py()), _TYPES[name])


def _bucket(row: pa.RecordBatch) -> Bucket:
    own = {c: _column(row, c) for c in ("word", "context", "count", "keys")}
    b = Bucket(row.column("bucket")[0].as_py(), own["word"].astype(np.int64), own["context"].astype(np.int64), own["count"], own["keys"])
    while f"shared{len(b.elsewhere)}" in row.schema.names:
        turn = len(b.elsewhere)
        blobs = row.column(f"shared{turn}")[0].as_py() or []
        told = np.frombuffer(b"".join(blobs), _TOLD[min(turn, 1)])
        at = np.searchsorted(b.keys, told["id"])
        b.elsewhere.append(b.elsewhere[0].copy() if turn else np.zeros(len(b.keys), np.int64))
        b.elsewhere[turn][at] = told["n"]
        if turn:
            b.seatings.append(row.column(f"seated{turn}")[0].as_py())
        else:
            b.guests, b.moving = np.zeros(len(b.keys), np.int64), np.zeros(len(b.keys), bool)
            b.guests[at], b.moving[at] = told["m"], told["q"] > 0
    return b


def told(table: DataFrame, exchanged: list[DataFrame]) -> DataFrame:
    """The table, with what its buckets were told after each round."""
    return reduce(lambda t, e: t.join(e.hint("shuffle_hash"), "bucket", "left"), exchanged, table)


# Kinds of rows that buckets pass on: sums, rare contexts, and seatings.
_BY_CONTEXT, _BY_HEAD, _HEAD_LEARNED, _TOTALS, _SHARED, _SEATED = range(6)
# Sums are added up in blocks of so many ids.
BLOCK = 1024
# Rare contexts are dealt, by their hash, to a part for so many buckets.
PART_BUCKETS = 8
# What buckets tell, and are told, of a rare context: its hash, tables, customers, and
# whether any pair of it has several; after the first round, the first two. A rare
# context has fewer customers than each of the head words, so 32 bits are enough.
_TOLD = (
    np.dtype([("id", "<u8"), ("n", "<u4"), ("m", "<u4"), ("q", "u1")]),
    np.dtype([("id", "<u8"), ("n", "<u4")]),
)


def _sums(table: DataFrame, buckets: int, turn: int, of) -> tuple[dict[int, list[tuple[int, bytes]]], DataFrame]:
    """Sums over all buckets of what ``of`` gives for each ({kind: array}), as
    {kind: [(block, sums)]}; the number of blocks is fixed: contexts, head words, totals.

    ``of`` also gives, for every rare context, its tables, customers and pairs of several
    customers, and the seatings its round left. A row for each bucket lists the contexts
    that other buckets have too, with the tables and customers there, and such pairs
    anywhere. After the first round, only contexts with such pairs are listed again: the
    others keep one table for each pair. Everything travels packed: a row for a bucket
    and block of sums, or part of the contexts.
    """
    parts, record = max(1, -(-buckets // PART_BUCKETS)), _TOLD[min(turn, 1)]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                b = _bucket(batch.slice(k, 1))
                found, shared, seated = of(b)
                at = np.arange(len(b.keys)) if b.moving is None else np.flatnonzero(b.moving)
                part = (b.keys[at] % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                listed = np.empty(len(at), record)
                for name, values in zip(record.names, (b.keys, *shared)):
                    listed[name] = values[at[order]]
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                own = [(_SHARED, i, listed[edges[i] : edges[i + 1]]) for i in np.flatnonzero(np.diff(edges)).tolist()]
                for kind, values in found.items():
                    values = np.asarray(values).astype("<i8")
                    blocks = (values[i : i + BLOCK] for i in range(0, len(values), BLOCK))
                    own += [(kind, i, v) for i, v in enumerate(blocks) if v.any()]
                rows = [(kind, i, b.number, v.tobytes()) for kind, i, v in own]
                if seated is not None:
                    rows.append((_SEATED, 0, b.number, seated))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    types, names = (pa.int32(), pa.int32(), pa.int32(), pa.binary()), ["kind", "part", "bucket", "blob"]
    schema = "kind int, part int, bucket int, blob binary"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for kind, part, blob in zip(*(batch.column(c).to_pylist() for c in ("kind", "part", "blob"))):
                whole[kind, part] = whole.get((kind, part), 0) + np.frombuffer(blob, "<i8")
        for (kind, part), values in whole.items():
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((kind, part, 0, values.tobytes()), types)], names)

    def met(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        """What each bucket is told of a part's contexts: sums without its own."""
        own = [np.frombuffer(blob, record) for _, blob in rows]
        listed = np.concatenate(own)
        _, at, several = np.unique(listed["id"], return_inverse=True, return_counts=True)
        told = listed.copy()
        for name in record.names[1:]:
            sums = np.bincount(at, listed[name]).astype(np.int64)[at]
            told[name] = sums > 0 if name == "q" else sums - listed[name]
        edges = np.cumsum([0, *map(len, own)])
        cut = (slice(*e) for e in zip(edges, edges[1:]))
        blobs = [told[i][several[at[i]] > 1].tobytes() for i in cut]
        values = ([_SHARED] * len(rows), [0] * len(rows), [bucket for bucket, _ in rows], blobs)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []
        for batch in batches:
            for part, bucket, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "bucket", "blob"))):
                if part != current and rows:
                    yield met(rows)
                    rows = []
                current = part
                rows.append((bucket, blob))
        if rows:
            yield met(rows)

    passed = table.drop("chunks", "rows", "chunk", "doc", "times")
    passed = stored(passed.mapInArrow(emit, schema), "sums", "zstd")
    kind, blob = F.col("kind"), F.col("blob")
    summed = passed.filter(kind < _SHARED).repartition("kind", "part").mapInArrow(add, schema).toArrow()
    found: dict[int, list[tuple[int, bytes]]] = {}
    for k, part, values in zip(*(summed.column(c).to_pylist() for c in ("kind", "part", "blob"))):
        found.setdefault(k, []).append((part, values))
    shared = passed.filter(kind == _SHARED).repartition(parts, "part").sortWithinPartitions("part").mapInArrow(meet, schema)
    dealt = shared.unionAll(passed.filter(kind == _SEATED)).repartition(buckets, "bucket").groupBy("bucket").agg(
        F.collect_list(F.when(kind == _SHARED, blob)).alias(f"shared{turn}"),
        F.first(F.when(kind == _SEATED, blob), ignorenulls=True).alias(f"seated{turn}"),
    )
    return found, dealt_table(dealt, buckets, "shared")


def _dense(found: list[tuple[int, bytes]] | None, n: int) -> np.ndarray:
    values = np.zeros(n, np.int64)
    for block, sums in found or []:
        values[block * BLOCK : (block + 1) * BLOCK] = np.frombuffer(sums, "<i8")
    return values


def _discount(ones: int, twos: int) -> float:
    return min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5


def first_counts(table: DataFrame, buckets: int) -> tuple[Counts, DataFrame]:
    """Everything with one table for each pair, and one for each token; and what
    buckets are to be told of other buckets."""

    def of(b: Bucket) -> tuple[dict[int, np.ndarray], list[np.ndarray], None]:
        pairs = (b.count > 0).astype(np.int64)
        sent, learned = b.by_tail(pairs), b.by_tail(b.count)
        totals = [int(sent.sum()), int((sent > 0).sum()), int((b.count == 1).sum()), int((b.count == 2).sum())]
        totals += [int((sent == 1).sum()), int((sent == 2).sum()), int(learned.sum())]
        by_context = np.concatenate((b.by_context(b.count), b.by_context(pairs)))
        sums = {_BY_CONTEXT: by_context, _BY_HEAD: b.by_head(pairs), _HEAD_LEARNED: b.by_head(b.count), _TOTALS: totals}
        return sums, [b.by_rare(pairs), b.by_rare(b.count), b.by_rare(b.count > 1) > 0], None

    found, shared = _sums(table, buckets, 0, of)
    contexts = _dense(found.get(_BY_CONTEXT), 2 * (START + 1))
    sent, learned = _dense(found.get(_BY_HEAD), HEAD), _dense(found.get(_HEAD_LEARNED), HEAD)
    tail_sent, tail_words, ones, twos, parent_ones, parent_twos, tail_learned = _dense(found.get(_TOTALS), 7).tolist()
    laid = (sent > 0).astype(np.int64)
    first = Counts(
        customers=contexts[: START + 1],
        learned=learned,
        distinct=int(laid.sum()) + tail_words,
        whole=int(learned.sum()) + tail_learned,
        discount=_discount(ones, twos),
        parent_discount=_discount(parent_ones + int((sent == 1).sum()), parent_twos + int((sent == 2).sum())),
        tables=contexts[START + 1 :],
        sent=sent,
        laid=laid,
        all_sent=int(sent.sum()) + tail_sent,
        all_laid=int(laid.sum()) + tail_words,
    )
    return first, shared


def next_counts(table: DataFrame, buckets: int, rounds: list[Counts], head: Seating | None) -> tuple[Counts, Seating, DataFrame]:
    """One more round in all buckets, given the counts of the rounds before and what
    buckets were ``told``, and in the parent's seating of head words."""
    g, turn = rounds[-1], len(rounds)

    def of(b: Bucket) -> tuple[dict[int, np.ndarray], list[np.ndarray], bytes]:
        for found, sent, laid in b.chain(rounds):
            pass
        sums = {_BY_CONTEXT: b.by_context(found), _BY_HEAD: b.by_head(found), _TOTALS: [int(sent.sum()), int(laid.sum())]}
        return sums, [b.by_rare(found)], _packed(b.left, int((b.count > 1).sum()), b.tail)

    found, shared = _sums(table, buckets, turn, of)
    sent = _dense(found.get(_BY_HEAD), HEAD)
    tail_sent, tail_laid = _dense(found.get(_TOTALS), 2).tolist()
    rng = np.random.default_rng([turn, 1 << 40])
    weight = np.full(HEAD, g.new_parent_table())
    if head is None:
        head = opened(rng, sent, weight, g.parent_discount)
    else:
        head = follow(rng, head, g.sent, sent, weight, g.parent_discount)
    head = sweep(rng, head, sent, weight, g.parent_discount)
    laid = head.tables(HEAD)
    after = replace(
        g,
        tables=_dense(found.get(_BY_CONTEXT), START + 1),
        sent=sent,
        laid=laid,
        all_sent=int(sent.sum()) + tail_sent,
        all_laid=int(laid.sum()) + tail_laid,
    )
    return after, head, shared


def probabilities(b: Bucket, rounds: list[Counts], samples: int = SAMPLES) -> np.ndarray:
    """Predictive probability of each pair, averaged over the last ``samples`` rounds."""
    whole = np.zeros(len(b.word))
    customers = np.concatenate((rounds[0].customers, b.by_rare(b.count, b.guests)))[b.context]
    for turn, (seated, sent, laid) in enumerate(b.chain(rounds[:-1]), 1):
        if turn + samples < len(rounds):
            continue
        g = rounds[turn]
        prior = b.prior(g, sent, laid)
        own = b.count - g.discount * seated
        back = STRENGTH + g.discount * b.tables(g, turn, seated)[b.context]
        whole += (own + back * prior) / (STRENGTH + customers)
    return whole / samples


# A document's place in its chunk; sums of the model, of the base, of known tokens.
_SUMS = ("<u2", "<f4", "<f8", "<u4")


def _partial(table: DataFrame, rounds: list[Counts]) -> DataFrame:
    """A bucket's sums for the documents of each chunk, packed."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield one(batch.slice(k, 1))

    def one(row: pa.RecordBatch) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1)
        b = _bucket(row)
        logs = np.log10(probabilities(b, rounds))
        learned = np.concatenate((rounds[0].learned, b.by_tail(b.count)))[b.word]
        plain = np.log10(learned + 0.1)
        del b
        rows, chunk, doc, times = (_column(row, c) for c in ("rows", "chunk", "doc", "times"))
        key = chunk.astype(np.int64) << 16 | doc
        del chunk, doc
        order = _order(key).astype(np.int32)
        key, times = key[order], times[order]
        pair = np.repeat(np.arange(len(rows), dtype=np.int32), rows)[order]
        del order, rows
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sums = [np.add.reduceat(v[pair] * times, first) for v in (logs, plain, (learned > 0).astype(np.float64))]
        key = key[first]
        chunks = row.column("chunks")[0].as_py()
        edges = np.searchsorted(key >> 16, np.arange(len(chunks) + 1))
        blobs = []
        for i in range(len(chunks)):
            own = slice(edges[i], edges[i + 1])
            columns = [key[own] & 0xFFFF, *(v[own] for v in sums)]
            blobs.append(squeeze.compress(b"".join(v.astype(k).tobytes() for v, k in zip(columns, _SUMS))))
        return pa.RecordBatch.from_arrays([pa.array(chunks, pa.string()), pa.array(blobs, pa.binary())], ["chunk", "blob"])

    return table.mapInArrow(score, "chunk string, blob binary")


def score(docs: DataFrame, train: str = "train", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, train, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``train``: a boolean column that marks the rows to learn from.
    """
    small_batches(docs.sparkSession)
    own = raw(docs, text, doc_id=doc_id, train=train).withColumn("train", F.coalesce("train", F.lit(False)))
    size = own.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    buckets = max(1, -(-size // (6 * BUCKET_TOKENS)))
    head = head_words(own)
    both = dealt_table(bucketed(packed(own, head, buckets), buckets), buckets)
    kept = both.filter("bucket < 0").select(F.col("chunks")[0].alias("chunk"), "doc_ids", "train", "n_tokens")
    table = both.filter("bucket >= 0").drop("doc_ids", "train", "n_tokens")

    first, shared = first_counts(table, buckets)
    rounds, exchanged, head_seating = [first], [shared], None
    for _ in range(ROUNDS):
        after, head_seating, shared = next_counts(told(table, exchanged), buckets, rounds, head_seating)
        rounds.append(after)
        exchanged.append(shared)
    whole, distinct = rounds[0].whole, rounds[0].distinct
    floor = float(np.log10(whole + 0.1 * (distinct + 1)))
    kind = docs.schema[doc_id].dataType.simpleString()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = sums = None

        def done() -> pa.RecordBatch:
            n = len(ids)
            values = [
                ids,
                learned,
                lengths,
                pa.array(sums[2].astype(np.int64)),
                pa.array(np.full(n, whole, np.int64)),
                pa.array(sums[1] - floor * lengths.to_numpy()),
                pa.array(sums[0]),
            ]
            return pa.RecordBatch.from_arrays(values, ["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                blob = row.column("blob")[0].as_py()
                if blob is None:
                    if ids is not None:
                        yield done()
                    ids, learned, lengths = (row.column(c).flatten() for c in ("doc_ids", "train", "n_tokens"))
                    sums = np.zeros((3, len(ids)))
                    continue
                blob = zstandard.decompress(blob)
                widths = [np.dtype(k).itemsize for k in _SUMS]
                n, at, columns = len(blob) // sum(widths), 0, []
                for form, width in zip(_SUMS, widths):
                    columns.append(np.frombuffer(blob, form, n, at))
                    at += n * width
                for i, values in enumerate(columns[1:]):
                    sums[i, columns[0]] += values
        if ids is not None:
            yield done()

    parts = _partial(told(table, exchanged), rounds)
    nothing = [F.lit(None).cast(kept.schema[c].dataType).alias(c) for c in ("doc_ids", "train", "n_tokens")]
    both = kept.select("chunk", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("blob"), "doc_ids", "train", "n_tokens")
    both = both.unionAll(parts.select("chunk", F.lit(1).alias("kind"), "blob", *nothing))
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", "kind")
    schema = f"doc_id {kind}, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return dealt.mapInArrow(gather, schema)
