"""Connected components by alternating star contractions, all in joins-free
group-bys of pairs: a round costs two shuffles of the edges left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the least of their group. ``large``: only those above
    the centre; else only those below it, and the centre itself.

    The least neighbour comes from a pre-aggregated group-by, so a node with very
    many neighbours is summed map-side; the join back is split by Spark if skewed.
    """
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    own = both if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = own.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    linked = own.join(least, "a")
    if large:
        pairs = linked.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        pairs = linked.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b"))
        )
    return pairs.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of comparable values; returns (a, b): every node that isn't
    the least of its component, and that least one."""
    state = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    while True:
        state = stored(_stars(_stars(state, True), False), "stars")
        # Done when every edge leads from a node with one edge to a least node.
        inner = state.select("a").join(state.select(F.col("b").alias("a")), "a", "left_semi")
        if inner.isEmpty() and state.groupBy("a").count().filter("count > 1").isEmpty():
            return state
