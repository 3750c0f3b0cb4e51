"""Best-fit packing by bin completion.

Documents become token ids with an end id; those over ``capacity`` are cut into
full pieces, the first of which may be shorter. Only the number of pieces of
each length matters for the packing: ``capacity`` numbers, however many
documents there are. On these the driver runs bin completion: take the largest
length left, enumerate the undominated fillings of the room beside it, and use
the best fit as often as the numbers allow. A dive for each of ``PRICES`` gives
the incumbent; then a branch is cut off once its waste exceeds what an
improvement could leave over. The search ends when the incumbent meets the lower
bound, or after ``NODES`` decisions. Each use of a filling exhausts a length, so the plan has as many
entries as there are lengths, not documents.

Pieces are then numbered within their length, in bounded groups, and take the
place that the plan gives their number.

Null and empty texts are the end id alone. Repeated rows are packed one by one,
null ids stay null, and texts of any length are cut whole. Which of several pieces
of one length gets which place is left open. An empty table gives no rows; other
columns, whatever their names, are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import raw, small_batches, stored
from surgelens.llm.wordpieces import BYTE_BPE, word_pieces

# Decisions of the search after the dives, fillings tried for one decision, and
# the groups that the pieces are numbered in, beside one for each length.
NODES = 20_000
PRICES = (0.0, 1.0, 4.0, 16.0, 64.0, 256.0, 1024.0)
WIDTH = 4
GROUPS = 8192

Pattern = tuple[tuple[int, ...], int]


def pieces(docs: DataFrame, capacity: int, end_id: int, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids) of every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = word_pieces(path)
        for batch in batches:
            source, rows = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(made.ids((text or b"").decode("utf-8", "replace")), np.uint32(end_id)).astype("<u4")
                first = len(ids) % capacity or capacity
                starts = [0, *range(first, len(ids), capacity)]
                for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    own = ids[a:b].tobytes()
                    source.append(k)
                    rows.append((i, a, b - a, zlib.crc32(own), own if with_ids else None))
            columns = list(zip(*rows)) or [()] * 5
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            values = [pa.array(c, t) for c, t in zip(columns, types)]
            doc_ids = batch.column("doc_id").take(pa.array(source, pa.int64()))
            named = [doc_ids, *values[: 5 if with_ids else 4]]
            yield pa.RecordBatch.from_arrays(named, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(named)])

    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def lower_bound(counts: np.ndarray) -> int:
    """Bins that any packing needs: by volume, and by what can't stand beside large pieces."""
    capacity = len(counts) - 1
    sizes = np.arange(capacity + 1)
    number, volume = np.cumsum(counts), np.cumsum(counts * sizes)
    best = -(-int(volume[-1]) // capacity)
    half = capacity // 2
    for p in range(half + 1):
        alone = int(number[-1] - number[capacity - p])
        middle = int(number[capacity - p] - number[half])
        room = middle * capacity - int(volume[capacity - p] - volume[half])
        small = int(volume[half] - (volume[p - 1] if p else 0))
        best = max(best, alone + middle + max(0, -(-(small - room) // capacity)))
    return best


class _State:
    """Counts by length, and the largest length left at or below any length."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.refresh()

    def refresh(self) -> None:
        held = np.where(self.counts > 0, np.arange(len(self.counts)), 0)
        self.below = np.maximum.accumulate(held)


def _dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the lengths of ``b`` can be put, whole, inside the lengths of ``a``."""

    def fits(rooms: tuple[int, ...], left: tuple[int, ...]) -> bool:
        if not left:
            return True
        return any(
            room >= left[0] and fits(tuple(sorted((*rooms[:i], room - left[0], *rooms[i + 1 :]))), left[1:])
            for i, room in enumerate(rooms)
            if i == 0 or rooms[i - 1] != room
        )

    return len(b) <= 8 and fits(tuple(sorted(a)), tuple(sorted(b, reverse=True)))


def fillings(state: _State, room: int, width: int = WIDTH, price: float = 0.0) -> list[tuple[int, ...]]:
    """The best undominated fillings of ``room``, least waste first; a further
    piece counts as ``price`` of waste, for small pieces are of use later on."""
    if room <= 0 or not state.below[room]:
        return [()]
    if state.counts[room]:
        return [(room,)]  # one piece that fills the room dominates all others
    found: set[tuple[int, ...]] = set()

    def greedy(taken: tuple[int, ...], left: int) -> tuple[int, ...]:
        used = Counter(taken)
        while left > 0 and (own := int(state.below[left])):
            while own and used[own] >= state.counts[own]:
                own = int(state.below[own - 1])
            if not own:
                break
            taken, left = (*taken, own), left - own
            used[own] += 1
        return tuple(sorted(taken, reverse=True))

    found.add(greedy((), room))
    held = np.flatnonzero(state.counts[1 : room + 1])[::-1] + 1
    partner = state.below[np.maximum(0, room - held)]
    same = (partner == held) & (state.counts[held] < 2)
    partner = np.where(same, state.below[np.maximum(0, partner - 1)], partner)
    pairs = held + partner
    for i in np.argsort(room - pairs, kind="stable")[: 2 * width].tolist():
        pair = (int(held[i]), int(partner[i])) if partner[i] else (int(held[i]),)
        found.add(greedy(pair, room - sum(pair)))
    for own in held[:width].tolist():
        rest = room - own
        near = np.flatnonzero(state.counts[1 : rest + 1])[::-1][: 64] + 1
        third = state.below[np.maximum(0, rest - near)]
        for i in np.argsort(rest - near - third, kind="stable")[:2].tolist():
            trio = Counter((own, int(near[i]), int(third[i])))
            trio.pop(0, None)
            if all(state.counts[n] >= k for n, k in trio.items()):
                found.add(greedy(tuple(trio.elements()), room - sum(trio.elements())))
    ranked = sorted(found, key=lambda f: (room - sum(f) + price * len(f), len(f), [-n for n in f]))
    kept: list[tuple[int, ...]] = []
    for own in ranked:
        if len(kept) < width and not any(_dominates(better, own) for better in kept):
            kept.append(own)
    return kept


def best_fit(numbers: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on numbers of lengths: (lengths of a bin, how many such bins).

    Best fit goes on filling the bin that it has just put a piece into for as long as
    the next one fits, so bins of one filling are treated together.
    """
    open_: dict[int, list[list]] = {}  # room left: [lengths, bins]
    for n in sorted(numbers, reverse=True):
        left = numbers[n]
        for room in [r for r in sorted(open_) if r >= n] + [None]:
            groups = open_.pop(room) if room is not None else [[(), left]]
            room = capacity if room is None else room
            each, kept = room // n, []
            for lengths, bins in groups:
                whole = min(bins, left // each)
                part = left - whole * each if bins > whole else 0
                left -= whole * each + min(part, each - 1 if part else 0)
                for k, times in ((each, whole), (part, 1 if part else 0)):
                    if times:
                        open_.setdefault(room - k * n, []).append([(*lengths, *[n] * k), times])
                if lengths and (rest := bins - whole - (1 if part else 0)):
                    kept.append([lengths, rest])
            if kept:
                open_.setdefault(room, []).extend(kept)
            if not left:
                break
    return [(lengths, times) for groups in open_.values() for lengths, times in groups]


def complete(numbers: dict[int, int], capacity: int, nodes: int = NODES) -> list[Pattern]:
    """Bin completion: (lengths of a bin, how many such bins), few bins in all."""
    dives = [_search(numbers, capacity, 0, price, None) for price in PRICES]
    used = [sum(times for _, times in plan) for plan in dives]
    price = PRICES[used.index(min(used))]
    incumbent = min([best_fit(numbers, capacity), *dives], key=lambda plan: sum(times for _, times in plan))
    return _search(numbers, capacity, nodes, price, incumbent)


def _search(
    numbers: dict[int, int], capacity: int, nodes: int, price: float, best: list[Pattern] | None
) -> list[Pattern]:
    """Depth first, from the incumbent ``best`` on, or one dive if there is none."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in numbers.items():
        counts[length] = n
    volume, bound = int((counts * np.arange(capacity + 1)).sum()), lower_bound(counts)
    fewest = sum(times for _, times in best or [])
    state = _State(counts)
    stack: list[tuple[list[tuple[tuple[int, ...], int]], Pattern | None]] = []
    plan: list[Pattern] = []
    bins = waste = spent = 0

    def options() -> list[tuple[tuple[int, ...], int]]:
        """Fillings with the part of their possible uses to make, the last one first."""
        top = int(state.below[capacity])
        state.counts[top] -= 1
        state.refresh()
        own = [(top, *f) for f in fillings(state, capacity - top, 1 if top == capacity else WIDTH, price)]
        state.counts[top] += 1
        state.refresh()
        shares = (1,) if best is None else (1, 2, 0)
        return [(f, share) for share in shares for f in own][::-1]

    def put(pattern: Pattern, sign: int) -> None:
        nonlocal bins, waste
        lengths, times = pattern
        for n in lengths:
            state.counts[n] -= sign * times
        state.refresh()
        bins += sign * times
        waste += sign * times * (capacity - sum(lengths))

    if volume:
        stack.append((options(), None))
    while stack:
        choices, used = stack[-1]
        if used is not None:
            put(used, -1)
            plan.pop()
            stack[-1] = (choices, None)
        if not choices or (best is not None and (fewest <= bound or spent >= nodes)):
            stack.pop()
            continue
        lengths, share = choices.pop()
        need = Counter(lengths)
        most = int(min(state.counts[n] // k for n, k in need.items()))
        times = most // share if share else 1
        if share != 1 and (times in (0, most) or share == 0 and most < 4):
            continue
        pattern = (lengths, times)
        put(pattern, 1)
        plan.append(pattern)
        stack[-1] = (choices, pattern)
        spent += best is not None
        if not state.below[capacity]:
            if best is None or bins < fewest:
                best, fewest = list(plan), bins
        elif best is None or waste <= (fewest - 1) * capacity - volume:
            stack.append((options(), None))
    return best or []


@dataclass
class Places:
    """For each length: where its numbered pieces go."""

    first: dict[int, list[int]]  # number of the first piece of each use of the length
    uses: dict[int, list[tuple[int, int, int]]]  # first bin, pieces in a bin, offset in the bin
    bins: int

    @staticmethod
    def of(plan: list[Pattern]) -> "Places":
        first: dict[int, list[int]] = {}
        uses: dict[int, list[tuple[int, int, int]]] = {}
        seen: Counter[int] = Counter()
        bins = 0
        for lengths, times in plan:
            offset = 0
            for n, k in sorted(Counter(lengths).items(), reverse=True):
                first.setdefault(n, []).append(seen[n])
                uses.setdefault(n, []).append((bins, k, offset))
                seen[n] += k * times
                offset += n * k
            bins += times
        return Places(first, uses, bins)

    def place(self, length: int, number: int) -> tuple[int, int]:
        i = bisect_right(self.first[length], number) - 1
        base, k, offset = self.uses[length][i]
        rest = number - self.first[length][i]
        return base + rest // k, offset + rest % k * length


def numbered(cut: DataFrame, counts: dict[int, int], capacity: int) -> DataFrame:
    """``cut`` with ``number``, from 0 within a length. Frequent lengths are dealt
    to several groups, numbered apart and then shifted by what came before."""
    rows = max(1, sum(counts.values()) // GROUPS)
    groups = [max(1, counts.get(n, 0) // rows) for n in range(1, capacity + 1)]
    of = F.expr(f"element_at(array({','.join(map(str, groups))}), int(length))")
    dealt = cut.withColumn("deal", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), of))
    sizes = dealt.groupBy("length", "deal").count().collect()
    base, shift, last = 0, [], None
    for r in sorted(sizes, key=lambda r: (r["length"], r["deal"])):
        base = base if r["length"] == last else 0
        shift.append((r["length"], r["deal"], base))
        base, last = base + r["count"], r["length"]
    shifts = cut.sparkSession.createDataFrame(shift, "length long, deal long, base long")
    turn = F.expr("row_number() OVER (PARTITION BY length, deal ORDER BY doc_id, piece, ids_crc32)")
    joined = dealt.withColumn("turn", turn).join(F.broadcast(shifts), ["length", "deal"])
    return joined.withColumn("number", F.col("base") + F.col("turn") - 1).drop("deal", "turn", "base")


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    path: str = BYTE_BPE,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset."""
    small_batches(docs.sparkSession)
    cut = stored(pieces(raw(docs, text, doc_id=doc_id), capacity, end_id, path, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    places = Places.of(complete(counts, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        found = [places.place(n, i) for n, i in zip(length.tolist(), number.tolist())]
        return pd.DataFrame(found, columns=["sequence_id", "offset"])

    rows = numbered(cut, counts, capacity).withColumn("at", placed("length", "number"))
    return rows.select(*cut.columns, "at.sequence_id", "at.offset")
