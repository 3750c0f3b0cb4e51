"""Repair of conversation structure by a grammar-compressed dynamic programme.

Every row becomes a symbol: the class of its role (``s``, ``u``, ``a``, ``o``
for any other), in upper case if its text is truncated, or ``x`` if it has to go
(blank or duplicate). Edits turn a row sequence into one whose role initials are
``(s?(ua)+)?``. Four states stand for what was put out so far, so a symbol is a
4x4 min-plus transfer matrix: the cheapest edits that lead from a state to a
state, the ASCII-least of equals.

Re-Pair replaces the pairs of symbols that are most frequent over all
conversations by new symbols, round by round; a round counts pairs in Spark. Each
rule has one matrix, the product of its halves', worked out once, bottom-up, and
used wherever the symbol occurs. Its audit is a rope: an entry holds only the
state at the seam, and is read out at the end. Ropes needn't be compared: from a
given state every edit letter leads to one state, and audits end with a row's
letter, so of two audits with different seams neither begins the other, and the
order of the left halves decides. A matrix keeps that order as ranks.

Sequences are cut into chunks of ``CHUNK`` rows, whatever the conversation's
length. Chunk matrices are multiplied pairwise, level by level, and the chosen
states are handed down again, so no task ever sees a whole conversation, but for
two outputs that are one value each by contract: the audit, a text with a letter
per edit, and the SHA-256 of the repaired text, which streams through one task.

Edits: keep ``K`` 0, rerole to user or assistant ``R`` 1, delete ``D`` 2, insert
an empty user or assistant turn ``I`` 5; an undeleted truncated row adds 5.

Defined results: a null conversation id is a conversation of its own; null roles
and texts are one space. Rows are ordered by turn (null first), role and text, so
repeated rows are neighbours. Conversations in ``whole`` without rows get zeros.
Texts of any length are judged whole. An empty table gives no rows; columns with
other names are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import small_batches, stored
from surgelens.llm.ordering import numbered

# What edits cost, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# White space, as in the rule for blank texts.
SPACES = " \t\n\x0b\x0c\r"

# Rows of a chunk; rules of the grammar, new rules of a round, and the fewest places a
# pair must occur in. They set how much is shared, never the result.
CHUNK = 1024
RULES, ROUND, LEAST = 4096, 512, 2

START, SYSTEM, USER, ASSISTANT = range(4)
FIRST_RULE = 0xE000
FAR = 1 << 50
# Fewest inserts that lead from a state to another, and where each role leads.
_INSERTS = {(START, USER): 1, (START, ASSISTANT): 2, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2, (USER, ASSISTANT): 1, (ASSISTANT, USER): 1}
_LEADS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_TO_END = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}


def _row_edits(symbol: str) -> dict[tuple[int, int], tuple[int, str]]:
    """(from, to): cost and letters of the best edits for one row, inserts before it included."""
    ways: dict[tuple[int, int], list[tuple[int, str]]] = {}
    role, added = symbol.lower(), TRUNCATED if symbol.isupper() else 0
    for p, q in product(range(4), range(4)):
        inserts = 0 if p == q else _INSERTS.get((p, q))
        if inserts is None:
            continue
        put = lambda to, cost, letter, p=p, n=inserts: ways.setdefault((p, to), []).append((INSERT * n + cost, "I" * n + letter))
        put(q, DELETE, "D")
        if symbol != "x":
            if q in _LEADS.get(role, {}):
                put(_LEADS[role][q], KEEP + added, "K")
            for new in "ua":
                if q in _LEADS[new]:
                    put(_LEADS[new][q], REROLE + added, "R")
    return {pair: min(found) for pair, found in ways.items()}


class Matrix:
    """Costs, ranks of the audits that leave from one state, and seams (16 each)."""

    __slots__ = ("cost", "rank", "seam")

    def __init__(self, cost: list[int], rank: list[int], seam: list[int] | None = None):
        self.cost, self.rank, self.seam = cost, rank, seam

    @staticmethod
    def of_row(symbol: str) -> "Matrix":
        best, cost, rank = _row_edits(symbol), [FAR] * 16, [9] * 16
        for p in range(4):
            own = sorted((best[p, q][1], q) for q in range(4) if (p, q) in best)
            for n, (_, q) in enumerate(own):
                cost[4 * p + q], rank[4 * p + q] = best[p, q][0], n
        return Matrix(cost, rank)

    def times(self, other: "Matrix") -> "Matrix":
        cost, rank, seam = [FAR] * 16, [9] * 16, [-1] * 16
        for p in range(4):
            order = []
            for q in range(4):
                least = min((self.cost[4 * p + s] + other.cost[4 * s + q], self.rank[4 * p + s], s) for s in range(4))
                if least[0] < FAR:
                    s = least[2]
                    cost[4 * p + q], seam[4 * p + q] = least[0], s
                    order.append((least[1], other.rank[4 * s + q], q))
            for n, (_, _, q) in enumerate(sorted(order)):
                rank[4 * p + q] = n
        return Matrix(cost, rank, seam)


class Grammar:
    """Rules as pairs of symbols, with a matrix and the audits of each."""

    def __init__(self, pairs: list[str]):
        self.pairs = pairs
        self.symbols = {pair: chr(FIRST_RULE + n) for n, pair in enumerate(pairs)}
        self.matrices = {c: Matrix.of_row(c) for c in "suaoSUAOx"}
        self.halves: dict[str, str] = {}
        for pair, symbol in self.symbols.items():
            self.halves[symbol] = pair
            self.matrices[symbol] = self.matrices[pair[0]].times(self.matrices[pair[1]])
        self.rows = {(c, *pair): way[1] for c in "suaoSUAOx" for pair, way in _row_edits(c).items()}
        self.audits: dict[tuple[str, int, int], str] = {}
        self.known: dict[str, Matrix] = {}

    def encode(self, text: str) -> str:
        """Rules applied in the order in which they were made."""
        while len(text) > 1:
            found = {text[i : i + 2] for i in range(len(text) - 1)}
            first = min((self.symbols[p] for p in found if p in self.symbols), default=None)
            if first is None:
                break
            text = text.replace(self.halves[first], first)
        return text

    def audit(self, symbol: str, p: int, q: int) -> str:
        key = (symbol, p, q)
        if symbol not in self.halves:
            return self.rows[key]
        if key not in self.audits:
            s = self.matrices[symbol].seam[4 * p + q]
            left, right = self.halves[symbol]
            self.audits[key] = self.audit(left, p, s) + self.audit(right, s, q)
        return self.audits[key]

    def matrix(self, text: str) -> Matrix:
        """The product over a chunk; chunks seen before by this worker are looked up."""
        if text not in self.known:
            if len(self.known) >= 1 << 14:
                self.known.clear()
            self.known[text] = self._chain(self.encode(text))[-1]
        return self.known[text]

    def _chain(self, encoded: str) -> list[Matrix]:
        chain = [self.matrices[encoded[0]]]
        for symbol in encoded[1:]:
            chain.append(chain[-1].times(self.matrices[symbol]))
        return chain

    def read(self, text: str, p: int, q: int) -> str:
        """The audit of a chunk from state ``p`` to state ``q``."""
        encoded = self.encode(text)
        chain, parts = self._chain(encoded), []
        for i in range(len(encoded) - 1, 0, -1):
            s = chain[i].seam[4 * p + q]
            parts.append(self.audit(encoded[i], s, q))
            q = s
        parts.append(self.audit(encoded[0], p, q))
        return "".join(reversed(parts))


def _known_rows(rows: DataFrame) -> DataFrame:
    """key, conv_id, turn, role, text: ``key`` stands for the id and is never null."""
    return rows.select(
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows as the dealt rule damages them, by the digest of conversation and turn."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return rows.filter("kind <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """key, at, pos, initial, fault, symbol of numbered rows. A row is a duplicate if
    another place is the first of its role and text; keys of that join are places."""
    first = rows.filter("end <> ''").groupBy("key", "digest").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("end") == "", "blank").when(F.col("first").isNull(), "duplicate").when(~F.col("end").isin(".", "!", "?"), "truncated")
    )
    role = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper("role")).otherwise(F.col("role"))
    marked = rows.join(first, ["key", "pos"], "left").withColumn("fault", fault).withColumn("role", role)
    return marked.select("key", "at", "pos", "initial", "fault", symbol.alias("symbol"))


def chunked(marked: DataFrame) -> DataFrame:
    """key, idx, symbols, places, illegal: a chunk sees the first role after it, too."""
    own = F.expr(f"pos div {CHUNK}")
    idx = F.explode(F.when((F.col("pos") % CHUNK == 0) & (F.col("pos") > 0), F.array(own, own - 1)).otherwise(F.array(own))).alias("idx")
    dealt = marked.select("key", idx, F.struct("pos", (F.col("pos")).alias("p"), "at", "initial", "symbol").alias("row"))
    rows = dealt.groupBy("key", "idx").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    inside = F.filter("rows", lambda r: F.expr("idx") == F.floor(r["p"] / CHUNK))
    steps = F.expr(
        "size(filter(sequence(2, greatest(2, size(rows))), i -> i <= size(rows) AND concat(element_at(rows, i - 1).initial,"
        " element_at(rows, i).initial) NOT IN ('su', 'ua', 'au')))"
    )
    cut = rows.select("key", "idx", inside.alias("inside"), steps.cast("long").alias("illegal"))
    each = lambda f: F.transform("inside", lambda r: r[f])
    return cut.select("key", "idx", F.array_join(each("symbol"), "").alias("symbols"), each("at").alias("places"), "illegal")


def learn(sequences: DataFrame) -> Grammar:
    """The rules that Re-Pair finds in ``symbols``: pairs are counted over all distinct
    sequences, by how often each occurs, and a round takes the most frequent ones."""
    distinct = stored(sequences.groupBy("symbols").agg(F.count("*").alias("n")), "sequences")
    pairs: list[str] = []
    while len(pairs) < RULES:
        grammar = Grammar(pairs)

        def counted(batches: Iterator[pa.RecordBatch], grammar=grammar) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found: dict[str, int] = {}
                for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    text = grammar.encode(text)
                    for i in range(len(text) - 1):
                        found[text[i : i + 2]] = found.get(text[i : i + 2], 0) + n
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["pair", "n"])

        counts = distinct.mapInArrow(counted, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        best = counts.filter(F.col("n") >= LEAST).orderBy(F.desc("n"), "pair").limit(min(ROUND, RULES - len(pairs)))
        new = [r["pair"] for r in best.collect()]
        if not new:
            break
        pairs += new
    return Grammar(pairs)


_ENTRIES = "cost array<long>, rank array<int>, seam array<int>"
_ENTRY_TYPES = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32())]


def _batch(names: list[str], types: list[pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _matrices(chunks: DataFrame, grammar: Grammar) -> DataFrame:
    def of_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, idx, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                m = grammar.matrix(text)
                out.append((key, idx, m.cost, m.rank, None))
            yield _batch(["key", "idx", "cost", "rank", "seam"], [pa.string(), pa.int64(), *_ENTRY_TYPES], out)

    return chunks.select("key", "idx", "symbols").mapInArrow(of_chunks, f"key string, idx long, {_ENTRIES}")


def _multiplied(level: DataFrame) -> DataFrame:
    """Neighbouring matrices as one; a last one without a neighbour stays as it is."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, idx, left, right in zip(*(batch.column(i).to_pylist() for i in range(4))):
                m = Matrix(left["cost"], left["rank"])
                m = m.times(Matrix(right["cost"], right["rank"])) if right else m
                out.append((key, idx, m.cost, m.rank, m.seam))
            yield _batch(["key", "idx", "cost", "rank", "seam"], [pa.string(), pa.int64(), *_ENTRY_TYPES], out)

    half = lambda odd: F.max(F.when(F.col("idx") % 2 == odd, F.struct("cost", "rank")))
    pairs = level.groupBy("key", F.expr("idx div 2").alias("idx")).agg(half(0).alias("l"), half(1).alias("r"))
    return pairs.mapInArrow(products, f"key string, idx long, {_ENTRIES}")


def _solved(chunks: DataFrame, grammar: Grammar) -> tuple[DataFrame, DataFrame]:
    """(key, cost) and (key, idx, p, q, tail): the states at both ends of every chunk
    on the best way, and the inserts after a conversation's last one."""
    levels = [stored(_matrices(chunks, grammar), "matrices")]
    while not levels[-1].filter("idx > 0").isEmpty():
        levels.append(stored(_multiplied(levels[-1]), "matrices"))
    ends = ", ".join(f"struct(cost[{s}] + {INSERT * n} AS cost, rank[{s}] AS rank, {s} AS state, {n} AS tail)" for s, n in _TO_END.items())
    best = levels[-1].select("key", "idx", F.expr(f"array_min(array({ends}))").alias("best"))
    costs = best.select("key", F.col("best.cost").alias("cost"))
    states = best.select("key", "idx", F.lit(START).alias("p"), F.col("best.state").alias("q"), F.col("best.tail").alias("tail"))
    for level in reversed(levels[1:]):
        at = states.join(level.select("key", "idx", "seam"), ["key", "idx"]).withColumn("s", F.expr("seam[4 * p + q]"))
        left = F.expr("struct(2 * idx AS idx, p, coalesce(s, q) AS q, CASE WHEN s IS NULL THEN tail ELSE 0 END AS tail)")
        right = F.expr("struct(2 * idx + 1 AS idx, s AS p, q, tail)")
        both = F.when(F.col("s").isNull(), F.array(left)).otherwise(F.array(left, right))
        states = stored(at.select("key", F.inline(both)), "states")
    return costs, states


def _edits(chunks: DataFrame, states: DataFrame, grammar: Grammar) -> DataFrame:
    """key, idx, audit, rows: per row its place, the turns put before it and its new
    role ('' kept, null deleted); inserts after the last row have no role and ``tail``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = pa.struct([("at", pa.int64()), ("part", pa.int32()), ("role", pa.string()), ("text", pa.string())])
        for batch in batches:
            out = []
            for key, idx, text, places, p, q, tail in zip(*(batch.column(i).to_pylist() for i in range(7))):
                audit, state, rows, n, pending = grammar.read(text, p, q) + "I" * tail, p, [], 0, []
                for letter in audit:
                    if letter in "IR":
                        state = ASSISTANT if state == USER else USER
                    elif letter == "K":
                        state = _LEADS[text[n].lower()][state]
                    role = "assistant" if state == ASSISTANT else "user"
                    if letter == "I":
                        pending.append(role + ":")
                        continue
                    kept = {"D": None, "K": ""}.get(letter, role)
                    rows.append({"at": places[n], "part": 0, "role": kept, "text": "\n".join(pending) if pending else None})
                    n, pending = n + 1, []
                if pending:
                    rows.append({"at": places[-1], "part": 2, "role": None, "text": "\n".join(pending)})
                out.append((key, idx, audit, rows))
            yield _batch(["key", "idx", "audit", "rows"], [pa.string(), pa.int64(), pa.string(), pa.list_(row)], out)

    at = chunks.join(states, ["key", "idx"]).select("key", "idx", "symbols", "places", "p", "q", "tail")
    return at.mapInArrow(read, "key string, idx long, audit string, rows array<struct<at:long,part:int,role:string,text:string>>")


def repaired_lines(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """key, at, part, role, text: in this order, edits (part 0) before their rows (1)."""
    said = rows.select("key", "at", F.lit(1).alias("part"), "role", "text")
    return edits.select("key", F.inline("rows")).unionByName(said)


def _digests(lines: DataFrame) -> DataFrame:
    """key, sha: SHA-256 of each conversation's lines, streamed in order."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, role, begun = None, None, None, False
        for batch in batches:
            done = []
            for own, part, new, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if own != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest, begun = own, hashlib.sha256(), False
                pieces = []
                if part != 1:
                    role = new
                    pieces = [] if text is None else [text]
                elif role is not None:
                    pieces = [f"{role or new}:{text}"]
                for piece in pieces:
                    digest.update(("\n" if begun else "").encode() + piece.encode())
                    begun = True
            yield _batch(["key", "sha"], [pa.string(), pa.string()], done)
        if key is not None:
            yield _batch(["key", "sha"], [pa.string(), pa.string()], [(key, digest.hexdigest())])

    in_order = lines.repartition("key").sortWithinPartitions("key", "at", "part").select("key", "part", "role", "text")
    return in_order.mapInArrow(hashed, "key string, sha string")


def _turn_gaps(rows: DataFrame) -> DataFrame:
    turns = rows.filter("turn IS NOT NULL").select("key", "turn").distinct()
    return turns.groupBy("key").agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))


def repair(rows: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """One row per conversation in ``whole`` (default: in ``rows``): conv_id, its faults
    (gaps, blank, duplicate, truncated, illegal), cost, audit, repaired_sha256."""
    small_batches(rows.sparkSession)
    end: Column = F.expr("right(trim(TRAILING ' \\t\\n\\u000b\\f\\r' FROM text), 1)")
    known = _known_rows(rows)
    kept = ["key", "turn", "role", "text"]
    placed = numbered(known.drop("conv_id"), "key", ["turn", "role", "text"], kept, "rows")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"))
    narrow = placed.select("key", "at", "pos", "turn", F.substring("role", 1, 1).alias("initial"), end.alias("end"), digest.alias("digest"))
    narrow = stored(narrow, "narrow")
    marked = stored(judged(narrow), "marked")
    chunks = stored(chunked(marked), "chunks")
    grammar = learn(chunks)
    costs, states = _solved(chunks, grammar)
    edits = stored(_edits(chunks, states, grammar), "edits")

    audits = edits.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("idx", "audit"))).alias("parts"))
    audits = audits.select("key", F.array_join(F.transform("parts", lambda p: p["audit"]), "").alias("audit"))
    count = lambda fault: F.count(F.when(F.col("fault") == fault, 1)).alias(fault)
    faults = marked.groupBy("key").agg(count("blank"), count("duplicate"), count("truncated"))
    illegal = chunks.groupBy("key").agg(F.sum("illegal").alias("illegal"))
    found = _known_rows(rows if whole is None else whole).select("key", "conv_id").distinct()
    for part in (_turn_gaps(narrow), faults, illegal, costs, audits, _digests(repaired_lines(placed.select("key", "at", "role", "text"), edits))):
        found = found.join(part, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return found.select(
        "conv_id",
        *map(zero, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
