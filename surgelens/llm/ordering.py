"""Places in an order, and look-ups by key, whatever share of the rows a key holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import stored

# A key with more than this share of the rows is looked up in a broadcast of such keys.
HOT_SHARE = 1 / 1024
HOT_ROWS = 1000


def numbered(rows: DataFrame, key: str, order: list[str], kept: list[Column | str], name: str) -> DataFrame:
    """``kept`` of every row, with ``at``, a number that rises over all rows in the
    order of (key, order), and ``pos``, the place from 0 among the rows of its key.

    Nulls come first. Equal rows are told apart by where they were read, so a
    range holds its share of the rows even if all are equal. A key may span any
    number of ranges; per key and range one row is joined back. The result is stored.
    """
    sort = [F.col(c).asc_nulls_first() for c in (key, *order)] + [F.col("_row")]
    dealt = rows.withColumn("_row", F.monotonically_increasing_id())
    ranged = dealt.repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = stored(ranged.select(*kept, F.monotonically_increasing_id().alias("at")), name)
    part = F.shiftright("at", 33).alias("_part")
    sizes = placed.groupBy(F.col(key).alias("_key"), part).agg(F.min("at").alias("_first"), F.count("*").alias("_n"))
    before = F.expr(
        "coalesce(sum(_n) OVER (PARTITION BY _key ORDER BY _part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    sizes = sizes.select("_key", F.col("_part").alias("_at_part"), (before - F.col("_first")).alias("_shift"))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.shiftright("at", 33) == F.col("_at_part"))
    joined = placed.join(sizes, same).withColumn("pos", F.col("at") + F.col("_shift"))
    return joined.drop("_key", "_at_part", "_shift")


def looked_up(rows: DataFrame, table: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with a stored ``table`` that holds each ``key`` once.

    Keys with more than ``HOT_SHARE`` of the rows, at most ``1 / HOT_SHARE`` of
    them, are joined by broadcast; the others by a shuffle, which deals them evenly.
    """
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    limit = max(HOT_ROWS, int((total or 0) * HOT_SHARE))
    if (most or 0) <= limit:
        return rows.join(table, key, how)
    hot = F.broadcast(counts.filter(F.col("_n") > limit).select(key))
    few = F.broadcast(table.join(hot, key, "left_semi"))
    return rows.join(hot, key, "left_semi").join(few, key, how).unionByName(rows.join(hot, key, "left_anti").join(table, key, how))
