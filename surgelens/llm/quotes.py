"""Quotation linking: from quoting messages to reply-ordered conversations.

A line's level is the number of its leading ``>``. A passage is a run of lines of
one level, ended by a blank line; its text is normalised (lower case, one space
for any white space), so wrapping doesn't matter, and hashed. A quoted passage
is linked to the latest earlier message that holds the same passage as its own
(level 0). A message's parent is the message that its passages of the lowest
linked level name, by most characters, then the latest. Roots, depths and reply
order follow by pointer jumping: a round doubles the steps taken.

"Latest earlier" is found without a join of equal passages: own and quoted
passages of a hash are sorted by message within stretches of the message order,
and stretches hand on the last message they saw. A passage that a third of all
messages hold is thus dealt over up to ``STRETCHES`` groups, and every quoted
passage yields one row.

Only DataFrame and SQL functions are used. Message ids are whole numbers in the
order of sending; ``numbered_messages`` gives such numbers to rows that have none.
Rows that repeat an id are one message (its least text). Rows without an id come
back without links. A null or empty text has no passages. Equal passages are
linked to the latest message before. Texts of any length are cut whole into lines.
An empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import stored
from surgelens.llm.ordering import looked_up, numbered
from surgelens.llm.splitters import rank_in

# Parts of the message order that are sorted apart, each with about as many messages.
STRETCHES = 4096

_MARKS = r"^(?:>[ \\t]?)+"


def numbered_messages(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``id``, from 0 in the order of ``order`` (nulls first): each row is
    a message of its own, however many share a key or are equal."""
    whole = numbered(rows.withColumn("_all", F.lit(0)), "_all", order, ["_all", *rows.columns], "messages")
    return stored(whole.withColumnRenamed("pos", "id").drop("at", "_all"), "messages")


def lines(messages: DataFrame) -> DataFrame:
    """id, line, level, body of every line of every text."""
    each = messages.select("id", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\r?\n")).alias("line", "raw"))
    marks = F.expr(f"regexp_extract(raw, '{_MARKS}', 0)")
    level = F.length(F.regexp_replace(marks, "[ \t]", ""))
    return each.select("id", "line", level.alias("level"), F.expr(f"regexp_replace(raw, '{_MARKS}', '')").alias("body"))


def passages(cut: DataFrame) -> DataFrame:
    """id, level, hash, length of every passage. A message's lines meet in one task."""
    blank = F.trim("body") == ""
    order = "OVER (PARTITION BY id ORDER BY line)"
    breaks = F.expr(f"blank OR coalesce(lag(level) {order} <> level, true)")
    marked = cut.withColumn("blank", blank).withColumn("breaks", breaks.cast("int"))
    runs = marked.withColumn("run", F.expr(f"sum(breaks) {order}")).filter(~F.col("blank"))
    joined = runs.groupBy("id", "level", "run").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "body"))), lambda x: x["body"]), " ").alias("text")
    )
    normal = F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))
    return joined.select("id", "level", normal.alias("text")).select(
        "id", "level", F.xxhash64("text").alias("hash"), F.length("text").alias("length")
    )


def stretch_bounds(named: DataFrame) -> list[int]:
    """Ids that part the messages into about equal stretches, wherever ids lie."""
    shares = [i / STRETCHES for i in range(1, STRETCHES)]
    found = named.agg(F.percentile_approx("id", shares, 10 * STRETCHES)).first()[0]
    return sorted(set(found or []))


def _stretched(df: DataFrame, bounds: list[int]) -> DataFrame:
    return df.withColumn("stretch", rank_in(bounds, "id"))


def linked(found: DataFrame, bounds: list[int]) -> DataFrame:
    """id, level, length, target: every quoted passage with an earlier original."""
    own = F.when(F.col("level") == 0, F.col("id"))
    rows = _stretched(found, bounds).withColumn("own", own)
    # At equal ids quoted passages come first: a message isn't its own original.
    here = F.expr("last(own, true) OVER (PARTITION BY hash, stretch ORDER BY id, level DESC ROWS UNBOUNDED PRECEDING)")
    quoted = rows.withColumn("here", here).filter("level > 0")
    ends = rows.groupBy("hash", "stretch").agg(F.max("own").alias("last"))
    before = F.expr(
        "max(last) OVER (PARTITION BY hash ORDER BY stretch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    ends = ends.select("hash", "stretch", before.alias("before"))
    joined = quoted.join(ends, ["hash", "stretch"])
    return joined.select("id", "level", "length", F.coalesce("here", "before").alias("target")).filter("target IS NOT NULL")


def parents(links: DataFrame) -> DataFrame:
    votes = links.groupBy("id", "level", "target").agg(F.sum("length").alias("length"))
    best = F.max(F.struct((-F.col("level")).alias("level"), "length", "target"))
    return votes.groupBy("id").agg(best.alias("best")).select("id", F.col("best.target").alias("parent_id"))


def roots(tree: DataFrame) -> DataFrame:
    """id, root_id, depth from (id, parent_id): each round doubles the steps taken.

    Rows that have reached a root rest. A message with very many replies is looked
    up by broadcast, so no task gets all of them.
    """
    top = tree.filter("parent_id IS NULL").select("id", F.col("id").alias("up"), F.lit(0).alias("depth"), F.lit(True).alias("done"))
    step = tree.filter("parent_id IS NOT NULL")
    tops = stored(top.select(F.col("id").alias("parent_id"), "done"), "tops")
    held = looked_up(step, tops, "parent_id", "left")
    state = held.select("id", F.col("parent_id").alias("up"), F.lit(1).alias("depth"), F.coalesce("done", F.lit(False)).alias("done"))
    state = stored(state, "ancestors")
    while not (open_ := state.filter("NOT done")).isEmpty():
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("done").alias("end"))
        moved = looked_up(open_, above, "up").select("id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.col("end").alias("done"))
        state = stored(state.filter("done").unionAll(moved), "ancestors")
    return top.unionAll(state).select("id", F.col("up").alias("root_id"), "depth")


def ordered(members: DataFrame, bounds: list[int]) -> DataFrame:
    """``members`` with ``position``, from 0 in each conversation, in reply order."""
    rows = _stretched(members, bounds)
    counts = rows.groupBy("root_id", "stretch").count()
    before = F.expr(
        "coalesce(sum(count) OVER (PARTITION BY root_id ORDER BY stretch"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    )
    counts = counts.select("root_id", "stretch", before.alias("before"))
    turn = F.expr("row_number() OVER (PARTITION BY root_id, stretch ORDER BY id)")
    joined = rows.withColumn("turn", turn).join(counts, ["root_id", "stretch"])
    return joined.withColumn("position", (F.col("before") + F.col("turn") - 1).cast("long")).drop("turn", "before", "stretch")


def conversations(messages: DataFrame, message_id: str = "id", text: str = "text") -> DataFrame:
    """id, parent_id, root_id, depth, position and text (without quotes) of every message.

    A conversation is all messages of a ``root_id``, in the order of ``position``;
    it stays as rows, since it may be of any length.
    """
    own = messages.select(F.col(f"`{message_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    named = own.filter("id IS NOT NULL").groupBy("id").agg(F.min("text").alias("text"))
    cut = stored(lines(named), "lines")
    bounds = stretch_bounds(named)
    links = parents(linked(stored(passages(cut), "passages"), bounds))
    tree = stored(named.select("id").join(links, "id", "left"), "replies")
    members = ordered(roots(tree), bounds)
    kept = cut.groupBy("id").agg(_text())
    whole = tree.join(members, "id").join(kept, "id", "left")
    columns = ["id", "parent_id", "root_id", "depth", "position", "text"]
    nameless = own.filter("id IS NULL").withColumn("id", F.monotonically_increasing_id())
    loose = lines(nameless).groupBy("id").agg(_text())
    empty = [F.lit(None).cast(t).alias(c) for c, t in zip(columns, ["long", "long", "long", "int", "long"])]
    return whole.select(*columns).unionAll(loose.select(*empty, "text"))


def _text() -> Column:
    """The own lines of a group as one text, in order, without white space around it."""
    rows = F.array_sort(F.collect_list(F.when(F.col("level") == 0, F.struct("line", "body"))))
    body = F.array_join(F.transform(rows, lambda x: x["body"]), "\n")
    return F.regexp_replace(body, r"^\s+|\s+$", "").alias("text")
