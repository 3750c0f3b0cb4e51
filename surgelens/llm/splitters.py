"""Sharding by sampled splitters: shards of near equal bytes, equal texts together.

A record's key is the hash of its text. Size-weighted samples of the keys give
quantile boundaries that cut the keys into many ranges of about equal bytes. A
range that got overfull holds a frequent key; such a key becomes a group of its
own and is subdivided by a number of each record. Exact byte counts of all ranges
and groups, a bounded number, then say which shard each goes to, the largest first.
Records of a frequent text stay in one shard as far as the law allows: while the
largest and the smallest shard differ by more than ``tolerance`` of the mean, texts
of half the size, and half of that, are dealt out in slices of about a range. A
single record is never cut.

Slots number a shard's records by range, then within the range, so no task sees
more than a range.

The sample has ``ranges * PER_RANGE`` keys or so, the counts ``3 * ranges`` rows
at most; nothing else reaches the driver. Only DataFrame operations are used.

A null text is an empty one: size 1, checksum 0. Repeated rows and null ids are
records like any other, told apart by where they were read; which of two equal
records gets which slot is left open. Texts of any length are sized whole. Of an
empty table nothing is returned; other columns are not read by ``assign`` and are
kept, whatever their names, by ``write``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import free_name, stored

PER_RANGE = 32


def _array(values: list[int]) -> str:
    return "array(" + ",".join("(-9223372036854775807L - 1L)" if v == -(2**63) else f"{v}L" for v in values) + ")"


def rank_in(bounds: list[int], key: str) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: a binary search."""
    if not bounds:
        return F.lit(0)
    steps, step = [], 1
    while step <= len(bounds):
        steps.append(step)
        step *= 2
    walk = ",".join(map(str, reversed(steps)))
    at = _array(bounds)
    return F.expr(
        f"aggregate(array({walk}), 0, (i, s) -> CASE WHEN i + s <= {len(bounds)} AND"
        f" element_at({at}, CASE WHEN i + s <= {len(bounds)} THEN i + s ELSE 1 END) <= {key} THEN i + s ELSE i END)"
    )


def splitters(records: DataFrame, total: int, ranges: int) -> list[int]:
    """Key boundaries between about equal bytes. A record of ``size`` is drawn with
    a chance of ``size`` in proportion; what is sure to be drawn keeps its weight."""
    wanted = ranges * PER_RANGE
    share = F.col("size") * F.lit(wanted / total)
    chance = F.pmod(F.xxhash64("key", "tie", F.lit("draw")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = records.filter(chance < share).select("key", F.greatest(share, F.lit(1.0)).alias("weight"))
    sample = sorted(drawn.groupBy("key").agg(F.sum("weight").alias("weight")).collect())
    whole = sum(w for _, w in sample)
    bounds, passed = [], 0.0
    for key, weight in sample:
        if passed * ranges >= (len(bounds) + 1) * whole and key not in bounds[-1:]:
            bounds.append(key)
        passed += weight
    return bounds


def _largest_first(items: list[tuple[int, tuple[int, ...]]], shards: int) -> dict[int, int]:
    """Units to shards: each item, the largest first, to the shard with the least."""
    filled, shard_of = [0] * shards, {}
    for size, units in sorted(items, reverse=True):
        shard = min(range(shards), key=lambda s: (filled[s], s))
        filled[shard] += size
        shard_of.update(dict.fromkeys(units, shard))
    return shard_of


def assign(
    docs: DataFrame,
    n_shards: int = 8,
    doc_id: str = "doc_id",
    text: str = "text",
    ranges: int = 2048,
    tolerance: float = 0.01,
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    records = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.xxhash64(body).alias("key"),
        # Equal records are of one group but not of one place.
        F.xxhash64(F.monotonically_increasing_id(), F.lit("tie")).alias("tie"),
    )
    records = stored(records, "records")
    total = records.agg(F.sum("size")).first()[0] or 1
    bounds = splitters(records, total, ranges)
    ranged = records.withColumn("range", rank_in(bounds, "key"))
    mean = total / ranges

    held = {r["range"]: r["size"] for r in ranged.groupBy("range").agg(F.sum("size").alias("size")).collect()}
    overfull = [k for k, size in held.items() if size > 2 * mean]
    frequent: list[tuple[int, int]] = []
    if overfull:
        inside = ranged.filter(F.col("range").isin(overfull))
        keys = inside.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        frequent = sorted((r["key"], r["size"]) for r in keys.filter((F.col("size") > mean) & (F.col("n") > 1)).collect())
    slices = [-(-size // max(1, int(mean))) for _, size in frequent]
    base, bases = len(bounds) + 1, []
    for n in slices:
        bases.append(base)
        base += n
    unit = F.col("range")
    if frequent:
        place = rank_in([k for k, _ in frequent], "key")
        known = F.expr(f"element_at({_array([k for k, _ in frequent])}, greatest(at, 1)) = key AND at > 0")
        of = lambda values: F.expr(f"element_at({_array(values)}, greatest(at, 1))")
        ranged = ranged.withColumn("at", place)
        unit = F.when(known, of(bases) + F.pmod("tie", of(slices))).otherwise(unit)
    dealt = ranged.withColumn("unit", unit.cast("int"))

    found = {r["unit"]: (r["size"], r["n"]) for r in dealt.groupBy("unit").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    plain = [(size, (u,)) for u, (size, _) in found.items() if u <= len(bounds)]
    groups = [(size, tuple(u for u in range(first, first + n) if u in found)) for (_, size), first, n in zip(frequent, bases, slices)]
    whole = total / n_shards
    while True:
        items = plain + [g for g in groups if g[0] <= whole]
        items += [(found[u][0], (u,)) for size, own in groups if size > whole for u in own]
        shard_of = _largest_first(items, n_shards)
        loads = [0] * n_shards
        for u, shard in shard_of.items():
            loads[shard] += found[u][0]
        if max(loads) - min(loads) <= tolerance * total / n_shards or not any(size <= whole for size, _ in groups):
            break
        whole /= 2
    filled, shift = [0] * n_shards, {}
    for u in sorted(found):
        shift[u] = filled[shard_of[u]]
        filled[shard_of[u]] += found[u][1]
    shards = ",".join(str(shard_of.get(u, 0)) for u in range(base))
    shifts = _array([shift.get(u, 0) for u in range(base)])
    turn = F.expr("row_number() OVER (PARTITION BY unit ORDER BY key, tie, doc_id, size)")
    return dealt.select(
        "doc_id",
        "size",
        "text_crc32",
        F.expr(f"element_at(array({shards}), unit + 1)").alias("shard"),
        (F.expr(f"element_at({shifts}, unit + 1)") + turn - 1).alias("slot"),
    )


def write(docs: DataFrame, path: str, n_shards: int = 8, doc_id: str = "doc_id", text: str = "text") -> None:
    """The documents as one folder of files per shard, large shards over several files."""
    row = free_name(docs, "row_number")
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    places = assign(kept, n_shards, row, text).select(F.col("doc_id").alias("_row_of_place"), "shard", "slot")
    rows = kept.join(places, kept[row] == F.col("_row_of_place")).select(*(kept[c] for c in docs.columns), "shard", "slot")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
