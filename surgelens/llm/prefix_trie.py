"""The prefix trie of conversations, built and summed by van Emde Boas recursion.

A sequence of symbols (turns, then an end mark) is cut into halves of a power of
two. On the way up, blocks of 1, 2, 4 ... symbols are named by a digest of the
names of their halves, each distinct block once (``dictionary``). On the way down
an item is a pair (root, block): the name of a prefix, and a block that follows
it. Cutting the block at half depth gives an item of the upper trie (root, left
half) and one of a lower forest (cut, right half), where ``cut``, a digest of
root and left half, names the prefix at the cut. Equal items are merged before
every cut, so a prefix that a third of the conversations share is one row from
there on, and all tries and forests of a level are cut in one job. The last
items, single symbols, are the trie's edges; the distinct roots are its nodes.

Totals of subtrees take the same way: the sum of a lower forest is grafted onto
its cut, level by level from the smallest; a block up to a cut thus carries all
that lies below it, and is cut down again to its nodes. ``d`` turns take about
``3 log2(d)`` rounds; each block and item occurs in one of them, so the work is
in proportion to the turns.

Defined results: rows without a conversation id belong to no conversation and
are left out. A null role or text is empty. Equal turns are ordered by role, then
text; repeated rows are turns of their own. Texts of any length are whole: from
the first step on a turn is a digest of 128 bits and its length. An empty table
has no nodes, not even a root. Columns with other names are ignored.

The digest ``ends_sha256`` reads the ids of the conversations that end in a node
in order: they are joined in runs of bounded length, and the runs of one node are
then hashed one after the other, as SHA-256 asks for, without being gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import small_batches, stored
from surgelens.llm.ordering import looked_up, numbered

# Turns that a conversation can take over from its first sibling: less than this.
HEADS = 6
SIBLINGS = 100
# Ids joined into one run of text.
RUN = 1 << 13

END, ROOT = "X'00'", "X'726F6F74'"


def _digest(kind: str, *parts: str) -> str:
    """SQL: 128 bits that name ``parts``."""
    return f"unhex(substring(sha2(concat(X'{kind.encode().hex()}', {', '.join(parts)}), 256), 1, 32))"


def symbols(turns: DataFrame) -> DataFrame:
    """conv, pos, sym: the digest and the length (8 bytes) of every turn, in order."""
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    said = "cast(concat(length(role), ':', role, text) AS binary)"
    sym = F.expr(f"concat({_digest('S', said)}, unhex(lpad(hex(length(text)), 16, '0')))")
    return stored(numbered(rows, "conv", ["turn", "role", "text"], ["conv", sym.alias("sym")], "turns"), "symbols").drop("at")


def rebuilt(syms: DataFrame) -> DataFrame:
    """conv, idx, name, last: each conversation begins with up to five turns of the
    first of its hundred, goes on with its own, and closes with an end mark."""
    heads = F.sort_array(F.collect_list(F.when(F.col("pos") < HEADS - 1, F.struct("pos", "sym")))).alias("heads")
    sizes = syms.groupBy("conv").agg(F.count("*").alias("own"), heads)
    taken = F.expr(f"int(crc32(cast(cast(conv AS string) AS binary)) % {HEADS})")
    convs = sizes.withColumn("h", taken).withColumn("base", F.expr(f"conv - conv % {SIBLINGS}"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("heads").alias("first"))
    convs = convs.drop("heads").join(bases, "base", "left").withColumn("first", F.expr("slice(coalesce(first, array()), 1, h)"))
    convs = convs.withColumn("k", F.size("first")).withColumn("last", F.expr("k + greatest(own - h, 0L)"))
    convs = stored(convs.select("conv", "h", "k", "last", "first"), "rebuilt")
    marks = convs.select("conv", F.col("last").alias("idx"), F.expr(END).alias("name"), "last")
    copied = convs.select("conv", F.expr("inline(first)"), "last").select("conv", F.col("pos").alias("idx"), F.col("sym").alias("name"), "last")
    rest = looked_up(syms, convs.drop("first"), "conv").filter("pos >= h")
    rest = rest.select("conv", F.expr("k + pos - h").alias("idx"), F.col("sym").alias("name"), "last")
    return marks.unionByName(copied).unionByName(rest)


def _grown(blocks: DataFrame, level: int) -> DataFrame:
    """Blocks of twice the length; a last one without a right half stays as it is."""
    half = lambda odd: F.max(F.when(F.col("idx") % 2 == odd, F.col("name")))
    pairs = blocks.groupBy("conv", F.expr("idx div 2").alias("idx"), F.expr("last div 2").alias("last")).agg(half(0).alias("l"), half(1).alias("r"))
    name = f"CASE WHEN r IS NULL THEN l ELSE {_digest(f'B{level}', 'l', 'r')} END"
    return pairs.select("conv", "idx", "last", F.expr(name).alias("name"), "l", "r")


def _merged(items: DataFrame) -> DataFrame:
    return items.groupBy("root", "depth", "block").agg(F.sum("n").alias("n"), F.min("conv").alias("conv"))


def _ends(whole: DataFrame) -> DataFrame:
    """conv, sha: per distinct sequence, its smallest conversation and the digest of all."""
    spread = numbered(whole, "name", ["conv"], ["name", "conv"], "ends")
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    runs = spread.groupBy("name", F.expr(f"pos div {RUN}").alias("run")).agg(F.min("conv").alias("conv"), ids.alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, first, digest = None, None, None
        for batch in batches:
            done: list[tuple] = []
            for n, c, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if n == name:
                    digest.update(b"," + ids.encode())
                else:
                    if digest:
                        done.append((first, digest.hexdigest()))
                    name, first, digest = n, c, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["conv", "sha"])
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([digest.hexdigest()])], ["conv", "sha"])

    in_order = runs.repartition("name").sortWithinPartitions("name", "run")
    return in_order.select("name", "conv", "ids").mapInArrow(hashed, "conv long, sha string")


def _cut(items: DataFrame, dictionary: DataFrame, level: int) -> DataFrame:
    """Items with the halves (``l``, ``r``) of their blocks and the name of the cut;
    all three are null where a block is no longer than the half."""
    halves = dictionary.select(F.col("name").alias("block"), "l", "r")
    cut = f"CASE WHEN r IS NOT NULL THEN {_digest('P', 'root', 'l')} END"
    return looked_up(items, halves, "block", "left").withColumn("cut", F.expr(cut))


def _halves(cut: DataFrame, size: int, values: list[str]) -> DataFrame:
    upper = cut.select("root", "depth", F.coalesce("l", "block").alias("block"), *values)
    lower = cut.filter("r IS NOT NULL").select(F.col("cut").alias("root"), (F.col("depth") + size).alias("depth"), F.col("r").alias("block"), *values)
    return upper.unionByName(lower)


def trie(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations in ``turns``
    (conv_id, turn, role, text); see the module for what is left out."""
    small_batches(turns.sparkSession)
    blocks = stored(rebuilt(symbols(turns)), "blocks")

    # Up: name blocks; a sequence that is one block waits at its level.
    wholes, dictionaries, level = [blocks.filter("last = 0")], [], 0
    blocks = blocks.filter("last > 0")
    while not blocks.isEmpty():
        level += 1
        grown = stored(_grown(blocks, level), f"level{level}")
        dictionaries.append(stored(grown.filter("r IS NOT NULL").select("name", "l", "r").distinct(), "dictionary"))
        wholes.append(grown.filter("last = 0"))
        blocks = grown.filter("last > 0").select("conv", "idx", "name", "last")

    # Down: cut tries and forests, all of a level at once.
    start = lambda whole: whole.groupBy(F.col("name").alias("block")).agg(F.count("*").alias("n"), F.min("conv").alias("conv")).select(
        F.expr(ROOT).alias("root"), F.lit(0).cast("long").alias("depth"), "block", "n", "conv"
    )
    items, cuts = start(wholes[level]), {}
    for k in range(level, 0, -1):
        cuts[k] = stored(_cut(stored(_merged(items), f"items{k}"), dictionaries[k - 1], k), f"cuts{k}")
        items = _halves(cuts[k], 1 << (k - 1), ["n", "conv"]).unionByName(start(wholes[k - 1]))
    edges = stored(_merged(items), "edges")

    nodes = _nodes(edges)
    totals = _totals(edges, nodes, cuts, level)
    named = lambda k: wholes[k].select(F.concat(F.lit(f"{k}:"), F.hex("name")).alias("name"), "conv")
    ends = _ends(reduce(DataFrame.unionByName, [named(k) for k in range(level + 1)]))
    # The end mark's edge and its sequence have the same smallest conversation.
    closing = edges.filter(f"block = {END}").select("root", "depth", "conv").join(ends, "conv").select("root", F.col("sha").alias("ends"))
    none = hashlib.sha256(b"").hexdigest()
    return nodes.join(closing, "root", "left").join(totals, ["conv", "depth"]).select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends", F.lit(none)).alias("ends_sha256"),
    )


def _nodes(edges: DataFrame) -> DataFrame:
    """root (the node's name), conv, depth, n_convs, n_children, chars, parent."""
    turn = F.col("block") != F.expr(END)
    found = edges.groupBy("root", "depth").agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n_convs"), F.sum(turn.cast("long")).alias("n_children")
    )
    found = stored(found, "nodes")
    above = found.select("root", F.col("conv").alias("parent"))
    chars = F.conv(F.hex(F.substring("block", 17, 8)), 16, 10).cast("long").alias("chars")
    into = looked_up(edges.filter(turn).select("root", "conv", (F.col("depth") + 1).alias("depth"), chars), above, "root").drop("root")
    return stored(found.join(into, ["conv", "depth"], "left"), "nodes")


def _totals(edges: DataFrame, nodes: DataFrame, cuts: dict[int, DataFrame], level: int) -> DataFrame:
    """conv, depth, n_leaves, saved_tokens of every node's subtree."""
    sums: list[Column] = [F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")]
    values = ["n_leaves", "saved_tokens"]
    own = nodes.select(
        "root",
        "depth",
        F.expr("bigint(n_children = 0)").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).alias("saved_tokens"),
    )
    # Up: the lower forest of a cut at level j is summed, then grafted onto its root.
    grafted: dict[int, DataFrame] = {}
    waiting = own
    for j in range(level):
        here = (F.col("depth") > 0) & (F.col("depth") % (1 << (j + 1)) == (1 << j))
        made = cuts[j + 1].filter("cut IS NOT NULL").select(F.col("cut").alias("own"), F.col("root").alias("to"), F.col("depth").alias("above"), "l").distinct()
        ready = waiting.filter(here).groupBy("root").agg(*sums).withColumnRenamed("root", "own")
        grafted[j] = stored(ready.join(made, "own"), f"grafted{j}")
        moved = grafted[j].groupBy(F.col("to").alias("root"), F.col("above").alias("depth")).agg(*sums)
        waiting = stored(waiting.filter(~here).unionByName(moved), "waiting")
    top = waiting.filter("depth = 0").groupBy("depth").agg(*sums)

    # Down: what lies below a cut belongs to every node of the block that leads to it.
    def leading(j: int) -> DataFrame:
        return grafted[j].select(F.col("to").alias("root"), F.col("above").alias("depth"), F.col("l").alias("block"), *values)

    loads = None
    for k in range(level - 1, 0, -1):
        loads = leading(k) if loads is None else loads.unionByName(leading(k))
        loads = loads.groupBy("root", "depth", "block").agg(*sums)
        halves = cuts[k].filter("r IS NOT NULL").select("root", "block", "l", "r", "cut")
        loads = stored(_halves(loads.join(halves, ["root", "block"]), 1 << (k - 1), values), f"loads{k}")
    root = nodes.filter("depth = 0").select("conv", "depth").join(top, "depth").select("conv", "depth", *values)
    if level == 0:
        return root
    loads = leading(0) if loads is None else loads.unionByName(leading(0))
    loads = loads.groupBy("root", "block").agg(*sums)
    below = edges.join(loads, ["root", "block"]).select("conv", (F.col("depth") + 1).alias("depth"), *values)
    return root.unionByName(below)
