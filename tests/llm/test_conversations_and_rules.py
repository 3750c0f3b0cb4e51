"""Structure repair, the prefix trie and the rule ensemble."""

import hashlib
import math
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from surgelens.llm import ordering, prefix_trie, queries, repair, rulefit
from surgelens.llm.langbits import residue

SF = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string, key string, conv string, idx int, pos string, at string, label string"


@pytest.fixture(scope="module")
def talk(spark):
    """Null and repeated ids, turns, roles and texts, one conversation with a third of
    the rows, ties, a very long text, and columns named like those used inside."""
    rnd = random.Random(3)
    roles = ["system", "user", "assistant", "tool", "", None, "user", "assistant"]
    texts = ["Hi.", "Go", "  ", "Ok!", "x?\n", "y y", None, "", "é.", "😀 no", "word " * 30_000 + "end."]
    rows = []
    for i in range(500):
        conv = rnd.choice([None, 100, -3]) if i % 3 == 0 else 7 if i % 3 == 1 else rnd.randint(-120, 260)
        text = rnd.choice(texts[: 11 if i % 50 == 0 else 10]) if i % 2 else f"t{rnd.randint(0, 300)}" + rnd.choice([".", "", "!"])
        rows.append((conv, rnd.choice([None, *range(40)]), rnd.choice(roles), text))
    rows += rows[:40]
    clash = ("c", "c", 1, "c", "c", "c")
    return spark.createDataFrame([(*r, *clash) for r in rows], TURNS).repartition(3).cache()


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


# ------------------------------------------------------------ places


def test_numbered_and_looked_up(spark, monkeypatch):
    rows = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE concat('k', id % 2) END AS k", "id % 7 AS v").repartition(5)
    got = ordering.numbered(rows, "k", ["v"], ["k", "v"], "numbered").collect()
    by_key = {}
    for r in sorted(got, key=lambda r: r["at"]):
        by_key.setdefault(r["k"], []).append((r["pos"], r["v"]))
    assert {k: len(v) for k, v in by_key.items()} == {None: 1000, "k0": 1000, "k1": 1000}
    for own in by_key.values():
        assert [p for p, _ in own] == list(range(1000)) and [v for _, v in own] == sorted(v for _, v in own)
    monkeypatch.setattr(ordering, "HOT_ROWS", 10)
    table = spark.createDataFrame([("k0", 1), ("k2", 2)], "k string, w int")
    for how in ("inner", "left"):
        want = sorted(map(str, rows.join(table, "k", how).collect()))
        assert sorted(map(str, ordering.looked_up(rows, table, "k", how).collect())) == want


# ------------------------------------------------------------ structure repair


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        out += [(c, t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for r, x in rows:
        body = x.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (r, x) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((r, x))
    return out


def cheapest(rows, marks):
    """A search over what was put out last, that keeps the best way to each."""
    follows = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "", ())}

    def inserted(best):
        for _ in range(4):
            for last, (c, a, o) in list(best.items()):
                for role in ("user", "assistant"):
                    to = follows.get((last, role[0]))
                    if to and (to not in best or (c + 5, a + "I") < best[to][:2]):
                        best[to] = (c + 5, a + "I", (*o, role + ":"))
        return best

    for (r, x), mark in zip(rows, marks):
        found = {}
        for last, (c, a, o) in inserted(best).items():
            ways = [(last, 2, "D", ())]
            if mark not in ("blank", "duplicate"):
                more = 5 if mark else 0
                ways += [(follows.get((last, r[:1])), more, "K", (f"{r}:{x}",))]
                ways += [(follows.get((last, n[0])), more + 1, "R", (f"{n}:{x}",)) for n in ("user", "assistant")]
            for to, cost, letter, put in ways:
                if to is not None and (to not in found or (c + cost, a + letter) < found[to][:2]):
                    found[to] = (c + cost, a + letter, (*o, *put))
        best = found
    return min((v for last, v in inserted(best).items() if last in ("", "a")), key=lambda v: v[:2])


def exhaustive(rows, marks):
    """All edit sequences with up to two inserts in a place."""
    best = None
    options = [["D"] if m in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for m in marks]
    gaps = ["", "u", "a", "ua", "au"]
    for letters in product(*options):
        for puts in product(gaps, repeat=len(rows) + 1):
            roles, cost, audit = "", 0, ""
            for i in range(len(rows) + 1):
                roles, cost, audit = roles + puts[i], cost + 5 * len(puts[i]), audit + "I" * len(puts[i])
                if i < len(rows):
                    way = letters[i]
                    cost += {"D": 2, "K": 0, "R": 1}[way[0]] + (5 if way != "D" and marks[i] else 0)
                    roles += "" if way == "D" else rows[i][0][:1] or "_" if way == "K" else way[1]
                    audit += way[0]
            if re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def repaired(rows, ids):
    out = []
    for c in ids:
        own = in_order([r for r in rows if r[0] == c])
        turns = {r[1] for r in own if r[1] is not None}
        pairs = [(r[2], r[3]) for r in own]
        marks = faults(pairs)
        cost, audit, put = cheapest(pairs, marks)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        counts = [marks.count(m) for m in ("blank", "duplicate", "truncated")]
        out.append((c, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(put).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("chunk", [1024, 7, 1])
def test_repair_matches_search(spark, talk, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    rows = rows_of(talk)
    got = repair.repair(repair.damaged(talk), talk).collect()
    assert sorted(str(tuple(r)) for r in got) == repaired(damage(rows), {r[0] for r in rows})


def test_repair_query(spark):
    rows = rows_of(queries.conversations(spark, SF))
    got = queries.QUERIES["op11_grammar_repair"](spark, SF).collect()
    assert sorted(str(tuple(r)) for r in got) == repaired(damage(rows), {r[0] for r in rows})


def test_search_and_matrices_match_all_edit_sequences():
    rnd, grammar = random.Random(1), repair.Grammar([])
    for _ in range(60):
        n = rnd.randint(0, 3)
        rows = [(rnd.choice(["system", "user", "assistant", "tool"]), f"{i}") for i in range(n)]
        marks = [rnd.choice([None, None, "truncated", "blank"]) for _ in rows]
        assert cheapest(rows, marks)[:2] == exhaustive(rows, marks)
        if rows:
            role = ["o" if r[0] == "t" else r[0] for r, _ in rows]
            text = "".join("x" if m == "blank" else c.upper() if m else c for c, m in zip(role, marks))
            m = grammar.matrix(text)
            best = min((m.cost[s] + 5 * tail, m.rank[s], s, tail) for s, tail in repair._TO_END.items())
            assert (best[0], grammar.read(text, 0, best[2]) + "I" * best[3]) == cheapest(rows, marks)[:2]


def test_grammar_shares_rules_and_changes_nothing(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choices("suaUAx", [1, 9, 9, 2, 2, 2], k=rnd.randint(1, 60))) for _ in range(200)]
    grammar = repair.learn(spark.createDataFrame([(t,) for t in texts], "symbols string"))
    plain = repair.Grammar([])
    assert grammar.pairs and sum(len(grammar.encode(t)) for t in texts) < sum(map(len, texts)) / 3
    for t in texts:
        a, b = grammar.matrix(t), plain.matrix(t)
        assert a.cost == b.cost and a.rank == b.rank
        assert [grammar.read(t, 0, q) for q in range(4) if a.cost[q] < repair.FAR] == [plain.read(t, 0, q) for q in range(4) if b.cost[q] < repair.FAR]


def test_repair_of_nothing(spark, talk):
    none = talk.filter("false")
    assert repair.repair(none).count() == 0
    zeros = repair.repair(none, talk).first()
    assert tuple(zeros)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


# ------------------------------------------------------------ prefix trie


def nodes(rows):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((c, t, r or "", x or ""))
    own = {c: [r[2:] for r in in_order(v)] for c, v in own.items()}
    built = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + seq[h:]
    members = {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for p, own_members in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(own_members) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))
        above = min(members[p[:-1]]) if p else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(m), len(p), above, len(m), len(children.get(p, [])), leaves[p], saved[p], digest))
    return sorted(map(str, out))


def test_trie_matches_brute_force(spark, talk, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 2)
    assert sorted(str(tuple(r)) for r in prefix_trie.trie(talk).collect()) == nodes(rows_of(talk))
    assert prefix_trie.trie(talk.filter("false")).count() == 0
    lone = next(c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6)  # its one turn is replaced by none
    turnless = talk.filter("conv_id = 7").limit(1).withColumn("conv_id", F.lit(lone))
    assert [tuple(r)[:7] for r in prefix_trie.trie(turnless).collect()] == [(lone, 0, None, 1, 0, 1, 0)]


def test_hot_prefixes_and_turns(spark, monkeypatch):
    """A third of the conversations are equal, and one turn is in all of them."""
    monkeypatch.setattr(ordering, "HOT_ROWS", 5)
    rows = []
    for c in range(240):
        for t in range(9 if c % 3 else 5):
            rows.append((c, t, "user", "same" if t % 2 or c % 3 == 0 else f"{c % 5}{t}"))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted(str(tuple(r)) for r in prefix_trie.trie(df).collect()) == nodes(rows)


# ------------------------------------------------------------ rule ensemble


def test_rules_of_a_printed_tree():
    shown = """tree
  If (feature 0 <= 2.5)
   If (feature 0 <= 1.5)
    Predict: 0.0
   Else (feature 0 > 1.5)
    Predict: 1.0
  Else (feature 0 > 2.5)
   Predict: 1.0"""
    found = {r.sql() for r in rulefit.paths(shown, ["a"])}
    assert found == {"(a <= 2.5D)", "(a <= 1.5D)", "(a > 1.5D AND a <= 2.5D)", "(a > 2.5D)"}


def test_statistics(spark, odd):
    text = "One two two, 3!\n\nOne two two, 3!\nABC|d?"
    df = spark.createDataFrame([(text,), (None,), ("",), (" \n ",)], "text string")
    got, *blank = rulefit.statistics(df).collect()
    words, size = text.split(), len("".join(text.split()))
    assert got["n_words"] == len(words) and got["n_lines"] == 3 and got["word_length"] == size / len(words)
    assert got["repeated_lines"] == 1 - 2 / 3 and got["symbols"] == 1 / size and got["upper_case"] == 5 / size
    assert got["digits"] == 2 / size and got["exclamations"] == 2 / len(words) and got["endings"] == 3 / len(words)
    assert got["letters"] == sum(c.isalpha() for c in text) / size and got["longest_word"] == 6.0
    for row in blank:
        assert row["n_words"] == 0 and row["symbols"] == 0 and all(v is not None and v == v for v in row)
    assert rulefit.statistics(odd).count() == odd.count()


def test_expression_equals_the_rules(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    figures = rulefit.statistics(docs, doc_id=F.col("doc_id")).cache()
    model = rulefit.fit(rulefit.labelled(figures, labels))
    assert 0 < len(model.rules) < 60
    for row in figures.withColumn("score", F.expr(model.sql())).limit(300).collect():
        z = model.base
        for rule, weight in model.rules:
            held = all((low is None or row[n] > low) and (high is None or row[n] <= high) for n, low, high in rule.bounds)
            z += weight * held
        assert row["score"] == pytest.approx(1 / (1 + math.exp(-z)))


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.QUERIES["op12_rule_ensemble"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = got.filter("held_out").join(labels, "doc_id")
    right = {r["quality"]: r["share"] for r in held.groupBy("quality").agg(F.avg(F.expr("int(predicted = quality)")).alias("share")).collect()}
    assert right[1] > 0.99 and right[0] > 0.97
    assert got.count() == 10_000 and got.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_ensemble_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (8, 0), (None, 1), (7, None), (2, 0)], "doc_id long, quality int")
    train = residue("doc_id", 5) != 9
    got = rulefit.classify(odd, labels, train)
    assert got.count() == odd.count() and got.filter("score IS NULL OR predicted IS NULL").count() == 0
    assert got.filter("doc_id = 5").select("score").distinct().count() == 1
    assert rulefit.classify(none, labels, train).count() == 0
    half = rulefit.classify(odd, labels.filter("false"), train).select("score").distinct().collect()
    assert [r[0] for r in half] == [0.5]
    ones = rulefit.classify(odd, labels.filter("doc_id = 4"), train).agg(F.min("score")).first()[0]
    assert ones > 0.99
