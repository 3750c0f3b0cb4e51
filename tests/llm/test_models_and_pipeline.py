"""Packing, personal data, language, language model, and the pipeline as a whole."""

import math
import random
import re
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from surgelens.llm import binpack, langbits, pitman_yor, queries, skipchain, wordpieces

SF = "/root/testdata/sf0.001"


def docs_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------ packing


def cut(text, capacity=1024):
    tokenizer = cut.__dict__.setdefault("tokenizer", Tokenizer.from_file(wordpieces.BYTE_BPE))
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
    first = len(ids) % capacity or capacity
    starts = [0, *range(first, len(ids), capacity)]
    return [(i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)]))]


def test_pieces_and_places(spark, odd, none):
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        found = binpack.pack(df).collect()
        want = sorted(str((d, *p)) for d, t in docs_of(df) for p in cut(t))
        assert sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in found) == want
        bins = defaultdict(list)
        for r in found:
            bins[r.sequence_id].append((r.offset, r.length))
        for own in bins.values():
            own.sort()
            assert [o for o, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
            assert sum(n for _, n in own) <= 1024
    assert binpack.pack(none).count() == 0


def best_fit(items, capacity):
    rooms, bins = [], 0
    for n in sorted(items, reverse=True):
        i = bisect_left(rooms, n)
        room = capacity if i == len(rooms) else rooms.pop(i)
        bins += i == len(rooms) and room == capacity
        insort(rooms, room - n)
    return bins


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion_is_no_worse_than_best_fit(seed):
    r = random.Random(seed)
    low, high, n = [(1, 1024, 40), (200, 700, 200), (1, 1024, 4000), (300, 500, 90), (100, 350, 500), (1, 60, 900)][seed]
    items = [r.randint(low, high) for _ in range(n)]
    plan = binpack.complete(Counter(items), 1024, nodes=500)
    used = Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 1024
        for k in lengths:
            used[k] += times
    counts = np.bincount(items, minlength=1025)
    assert used == Counter(items)
    assert binpack.lower_bound(counts) <= sum(t for _, t in plan) <= best_fit(items, 1024)


def test_small_instances_are_optimal():
    def fewest(items, rooms):
        if not items:
            return len(rooms)
        n, rest = items[0], items[1:]
        tried = {r: i for i, r in enumerate(rooms) if r >= n}
        options = [fewest(rest, rooms[:i] + (r - n,) + rooms[i + 1 :]) for r, i in tried.items()]
        return min([*options, fewest(rest, (*rooms, 20 - n))])

    r = random.Random(0)
    for _ in range(40):
        items = sorted((r.randint(2, 19) for _ in range(8)), reverse=True)
        assert sum(t for _, t in binpack.complete(Counter(items), 20)) == fewest(tuple(items), ())


def test_dominance():
    assert binpack._dominates((7, 3), (4, 3, 3)) and not binpack._dominates((5, 5), (6, 4))


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_on_numbers_is_best_fit(seed):
    r = random.Random(seed)
    low, high, n = [(1, 1024, 300), (1, 40, 2000), (300, 520, 500), (100, 110, 1000), (1, 3, 5000), (513, 1024, 50), (200, 260, 999), (1, 1024, 3)][seed]
    items = [r.randint(low, high) for _ in range(n)]
    plan, used = binpack.best_fit(Counter(items), 1024), Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 1024 and times > 0
        for k in lengths:
            used[k] += times
    assert used == Counter(items) and sum(t for _, t in plan) == best_fit(items, 1024)


def test_fewer_uses_of_a_filling_are_reached():
    """Sixes and fours of ten: using 4+6 for all leaves nothing to gain; 3s and 7s need a mix."""
    numbers = {7: 4, 6: 3, 4: 5, 3: 6, 2: 3}
    plan = binpack.complete(numbers, 10)
    assert sum(t for _, t in plan) == binpack.lower_bound(np.bincount(list(Counter(numbers).elements()), minlength=11))


def test_special_tokens_are_those_of_the_tokenizer(spark):
    plain = Tokenizer.from_file(wordpieces.BYTE_BPE)
    made = wordpieces.word_pieces(wordpieces.BYTE_BPE)
    for text in ("x <|endoftext|> y", "<|endoftext|><|endoftext|>", "<|endoftext|", "plain words"):
        assert made.ids(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert len(made.ids("<|endoftext|>")) == 1


def test_runs_of_spaces_are_encoded():
    made = wordpieces.word_pieces(wordpieces.BYTE_BPE)
    text = "a" + " " * 200_000 + "<|endoftext|> b"
    assert made.ids(text).tolist() == made.plain(text)


# ------------------------------------------------------------ personal data


def base(text):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", skipchain.IP, skipchain.CARD, skipchain.PHONE]
    found = []
    for k, pattern in enumerate(patterns):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = [
                True,
                all(int(p) <= 255 for p in re.findall("[0-9]+", m.group())),
                14 <= len(digits) <= 19 and skipchain.luhn(digits),
                10 <= len(digits) <= 15,
            ][k]
            if fine:
                found.append((*m.span(), k))
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_base_spans_match_the_patterns():
    r = random.Random(1)
    for _ in range(4000):
        text = "".join(r.choice("a1.@+- ()9é|45\n") for _ in range(r.randint(0, 60)))
        assert skipchain.base_spans(text) == base(text)
    assert skipchain.luhn("4041894974608795") and not skipchain.luhn("4041894974608796")


def test_long_tokens_take_linear_time():
    skipchain.find(["a" * 400_000 + "@" + "1" * 400_000 + ".", "1 " * 20_000], skipchain.fit(skipchain.Graph.empty()))


@pytest.fixture(scope="module")
def weights(spark):
    return skipchain.learn(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_base_stays_and_prose_gets_no_spans(spark, weights, odd, none):
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        want = Counter((d, tuple(base(t))) for d, t in docs_of(df))
        number = {k: i for i, k in enumerate(skipchain.KINDS)}
        rows = skipchain.detect(df, weights).collect()
        assert Counter((r.doc_id, tuple((s.start, s.end, number[s.kind]) for s in r.base)) for r in rows) == want
        assert all(set(r.base) <= set(r.spans) for r in rows)
    assert skipchain.detect(none, weights).count() == 0
    for text in ("Built 2020-01-02 in 1999, version 4.0 of 12 345 678.", "Rooms 101 and 202 at 10:30", "9876543210 items"):
        assert skipchain.find([text], weights) == [([], [])]


def test_repeated_tokens_agree(weights):
    text = "Call +1 (988) 555-2485 today. " + "Plain words here. " * 300 + "Again 555-2485 x, or (988) 555-2485."
    first, whole = skipchain.find([text], weights)[0]
    assert len(first) == 1 and [text[s:e] for s, e, k in whole if k == 3] == ["+1 (988) 555-2485", "555-2485", "(988) 555-2485"]
    # The same digits alone, never written as a phone number, stay as they are.
    assert skipchain.find(["Again 555-2485 x"], weights) == [([], [])]


def test_messages_give_exact_beliefs_on_a_tree():
    rng = np.random.default_rng(0)
    n = 4
    graph = skipchain.Graph([0] * n, [(i, i + 1) for i in range(n)], [[i] for i in range(n)], [[True] * 5] * n, [0] * n, [(0, 1), (1, 2)], [(0, 3)])
    w = skipchain.Weights(rng.normal(size=(skipchain.BUCKETS, 5)), rng.normal(size=(5, 5)), np.diag(rng.normal(size=5)))
    exact = np.zeros((n, 5))
    for y in np.ndindex(5, 5, 5, 5):
        s = sum(w.unary[i, y[i]] for i in range(n)) + w.chain[y[0], y[1]] + w.chain[y[1], y[2]] + w.skip[y[0], y[3]]
        for i in range(n):
            exact[i, y[i]] += math.exp(s)
    assert np.allclose(skipchain.beliefs(graph, w, 200), exact / exact.sum(1, keepdims=True), atol=1e-3)


def test_beliefs_of_a_text_do_not_depend_on_its_batch(weights):
    texts = ["Call +1 (988) 555-2485 now. " + "word " * 20 + "or 9885552485 again. " * 30, "mail a.b@c.example.org", "10.2.3.4 and 10.2.3.4 " * 40, None, ""]
    alone = [skipchain.find([t], weights)[0] for t in texts]
    assert skipchain.find(texts, weights) == alone == skipchain.find(texts[::-1], weights)[::-1]


def test_redaction(weights, odd, none):
    row = skipchain.redact(odd.filter("doc_id = 8"), weights).first()
    assert row.text == "Write to <EMAIL> or <PHONE>. MIT License\nmit license <IP>"
    assert skipchain.redact(odd, weights).columns == odd.columns and skipchain.redact(none, None).count() == 0
    assert skipchain.learn(none) is None


# ------------------------------------------------------------ language


def test_held_out_languages(spark):
    got = queries.QUERIES["op8_language_bits"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = dict(map(tuple, got.join(labels, "doc_id").groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).collect()))
    assert right[True] > 0.98 and right[False] > 0.98


def learned_sets(rows):
    """(language, n-gram): rate, by hand."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        if lang is not None and text is not None:
            grams = langbits.ngrams(text)[0].tolist()
            counts.update((lang, g) for g in grams)
            totals[lang] += len(grams)
    return {k: n / totals[k[0]] for k, n in counts.items()}, {k: n for k, n in totals.items() if n}


def brute_verdict(text, rates, totals):
    """The decision from exact sets: what the filter gives but for chance hits."""
    grams, lettered = langbits.ngrams(text) if text else (None, False)
    if not lettered or not totals:
        return None
    found = {}
    for lang in sorted(totals):
        found[lang] = sum(sum(rates[lang, g] >= band for band in langbits.BANDS) for g in grams.tolist() if (lang, g) in rates)
    return found


@pytest.mark.parametrize("table_bytes", [1 << 26, 20_000])
def test_answers_match_exact_sets(spark, odd, monkeypatch, table_bytes):
    """In one part and in several, popcounts are those of exact sets but for chance."""
    monkeypatch.setattr(langbits, "TABLE_BYTES", table_bytes)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [(r.lang, r.text) for r in docs.collect()]
    model = langbits.learn(docs)
    assert (model.n_parts > 1) == (table_bytes == 20_000)
    rates, totals = learned_sets(rows)
    assert (model.langs, model.weights) == (sorted(totals), [totals[k] for k in sorted(totals)])
    got = {r.doc_id: r for r in langbits.predict(docs, model).collect()}
    for r in docs.collect():
        want = brute_verdict(r.text, rates, totals)
        if want is None:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        best, other = sorted(want.values(), reverse=True)[:2]
        assert got[r.doc_id].score == pytest.approx(best / sum(want.values()), abs=0.12)
        if best > 1.2 * other + 5:
            assert want[got[r.doc_id].lang_pred] == best
    assert langbits.predict(odd, model).count() == odd.count()


def test_filter_returns_all_languages_that_hold_a_gram(spark):
    """Seventy languages, each with its own n-grams and some that all share."""
    rows = [(f"l{k:02}", g, 1 + g % 3) for k in range(70) for g in [*range(1000 * k, 1000 * k + 60), *range(500_000, 500_030)]]
    model = langbits.from_counts(spark.createDataFrame(rows, "lang string, gram long, n long"))
    part, n = model.part(0), len(langbits.BANDS)
    shared = part.hits(np.arange(500_000, 500_030, dtype=np.uint64)).reshape(70, n)
    assert (shared[:, -1] == 30).all() and model.n_words == 5
    for k in (0, 15, 16, 69):
        own = part.hits(np.arange(1000 * k, 1000 * k + 60, dtype=np.uint64)).reshape(70, n)
        assert own[k, -1] == 60 and np.delete(own[:, -1], k).max() < 10


def test_fill_is_bounded_whatever_is_learned(spark):
    """A language with five million n-grams beside one of two short texts."""
    big = spark.range(5_000_000).selectExpr("'big' AS lang", "xxhash64(id) AS gram", "1L AS n")
    small = langbits.ngrams("kleine sprache mit zwei texten, sehr kurz")[0].view(np.int64)
    few = spark.createDataFrame([("few", int(g), 1) for g in set(small.tolist())], "lang string, gram long, n long")
    model = langbits.from_counts(big.union(few))
    part = model.part(0)
    assert model.n_parts == 1 and part.fill.max() <= langbits.FILL
    assert model.verdict(part.counted(small.view(np.uint64)))[0] == "few"
    ids = [r[0] for r in big.select("gram").limit(400).collect()]
    assert model.verdict(part.counted(np.array(ids, np.int64).view(np.uint64)))[0] == "big"
    assert langbits.slots_for(0) == 4096 and langbits.slots_for(10**7) == 1 << 27


def test_a_language_of_two_documents_is_found(spark):
    rows = [(i, "the quick brown fox jumps over the lazy dog and runs away from there", "en") for i in range(200)]
    rows += [(900, "zwei kurze texte einer kleinen sprache", "xx"), (901, "noch ein kurzer text in dieser sprache", "xx")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langbits.predict(docs, langbits.learn(docs)).collect()}
    assert got[900] == got[901] == "xx" and got[0] == "en"


def test_grams():
    assert len(langbits.ngrams("Ab, c")[0]) == 4 and langbits.ngrams("12 -")[1] is False
    assert np.array_equal(langbits.ngrams("ab..  c")[0], langbits.ngrams("AB c")[0])
    assert langbits.ngrams("日本 🙂")[1] and langbits.ngrams("𝒜b")[1]


def test_odd_texts_get_a_language(odd, none):
    found = langbits.predict(odd, langbits.learn(odd)).collect()
    assert len(found) == odd.count()
    assert {r.lang_pred for r in found if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(0 <= r.score <= 1 for r in found)
    assert {r.lang_pred for r in langbits.predict(odd, langbits.learn(none)).collect()} == {"und"}
    assert langbits.predict(none, langbits.learn(odd)).count() == 0


# ------------------------------------------------------------ language model


def plain_scores(docs, learned):
    tokens = {i: [*(t or "").encode().lower().split(), None] for i, t in docs}
    counts = Counter(x for i, own in tokens.items() if learned(i) for x in own)
    whole, distinct = sum(counts.values()), len(counts)
    logs = {i: sum(math.log10((counts[x] + 0.1) / (whole + 0.1 * (distinct + 1))) for x in own) for i, own in tokens.items()}
    return {i: (len(own), sum(counts[x] > 0 for x in own), whole, logs[i]) for i, own in tokens.items()}


def test_base_scores_and_perplexity(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 60_000)  # several buckets
    got = queries.QUERIES["op3_pitman_yor"](spark, "/root/testdata/sf0.01").collect()
    docs = docs_of(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    want = plain_scores(docs, lambda i: zlib.crc32(str(i).encode()) % 10 != 0)
    assert len(got) == len(docs)
    for r in got:
        n, known, whole, logs = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, whole)
        assert r.base_score == pytest.approx(logs, rel=1e-9) and r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > 0.9 * sum(r.base_score for r in held)


def test_probabilities_sum_to_one():
    """Over all learned tokens and the unknown one, in every context."""
    rng = np.random.default_rng(1)
    words, contexts = [*range(6), pitman_yor.HEAD, pitman_yor.HEAD + 1], [1, 2, pitman_yor.START]
    pairs = sorted((w, c) for w in words for c in contexts)
    count = rng.integers(0, 300, len(pairs)) * (rng.random(len(pairs)) < 0.6)
    b = pitman_yor.Bucket(0, np.array([w for w, _ in pairs]), np.array([c for _, c in pairs]), count)
    one = lambda n: np.bincount([c for _, c in pairs], n, pitman_yor.START + 1).astype(np.int64)
    held = (count > 0).astype(np.int64)
    g = pitman_yor.Counts(one(count), b.by_head(count).astype(np.int64), 8, int(count.sum()), 0.7, 0.6, one(held), b.by_head(held).astype(np.int64), (b.by_head(held) > 0).astype(np.int64), int(held.sum()), 8)
    (seated, sent, laid), = b.chain([g])
    head = b.by_head(seated).astype(np.int64)
    head_laid = (head > 0).astype(np.int64)
    after = pitman_yor.Counts(g.customers, g.learned, 8, g.whole, 0.7, 0.6, one(seated), head, head_laid, int(head.sum() + sent.sum()), int(head_laid.sum() + laid.sum()))
    p = pitman_yor.probabilities(b, [g, after], samples=1)
    unknown = after.parent(np.zeros(1), np.zeros(1))[0]
    learned = np.concatenate((head, sent)) > 0
    for c in contexts:
        back = (pitman_yor.STRENGTH + 0.7 * after.tables[c]) / (pitman_yor.STRENGTH + after.customers[c])
        own = sum(x for (w, k), x in zip(pairs, p) if k == c and learned[w])
        missing = 8 - sum(learned)  # tokens that were never learned here keep the unknown one's share
        assert own + back * unknown * (1 + missing) == pytest.approx(1.0, abs=1e-9)
    assert ((seated >= 1) == (count >= 1)).all() and (seated <= count).all()


def seating_law(c, weight, discount):
    """Chance of each number of tables for ``c`` customers of one dish, by listing
    how tables can be joined and opened."""
    law = {1: 1.0}
    for seated in range(1, c):
        step = {}
        for t, p in law.items():
            step[t] = step.get(t, 0.0) + p * (seated - discount * t)
            step[t + 1] = step.get(t + 1, 0.0) + p * weight
        whole = sum(step.values())
        law = {t: p / whole for t, p in step.items()}
    return law


@pytest.mark.parametrize("c, weight, discount, error", [(2, 0.7, 0.3, 0.02), (6, 1.5, 0.6, 0.02), (8, 0.2, 0.0, 0.02), (60, 1.5, 0.4, 0.05), (900, 3.0, 0.7, 0.05)])
def test_gibbs_chain_keeps_the_seating_law(c, weight, discount, error):
    """The chain forgets its first seating, all at one table or near the law."""
    rng, n = np.random.default_rng(5), 4000
    count, weights = np.full(n, c), np.full(n, weight)
    want = seating_law(c, weight, discount)
    first = pitman_yor.opened(rng, count, weights, discount)
    assert (np.bincount(first.owner, first.size, n) == c).all()
    for s, sweeps in ((pitman_yor.Seating(np.arange(n), count), 120), (first, 20)):
        for _ in range(sweeps):
            s = pitman_yor.sweep(rng, s, count, weights, discount)
            assert (np.bincount(s.owner, s.size, n) == c).all() and (s.size > 0).all() and (np.diff(s.owner) >= 0).all()
        tables = s.tables(n)
        assert tables.mean() == pytest.approx(sum(t * p for t, p in want.items()), rel=error)
        assert all(abs((tables == t).mean() - p) < 0.04 for t, p in want.items())


def test_first_seatings_of_single_customers():
    rng = np.random.default_rng(3)
    for discount in (0.05, 0.5, 0.95):
        for n in (0, 40):
            s = pitman_yor.opened(rng, np.arange(n) % 4, np.full(n, 9.0), discount)
            assert (np.bincount(s.owner, s.size, n) == np.arange(n) % 4).all()


def test_a_round_goes_on_from_the_seating_before():
    rng = np.random.default_rng(7)
    count = rng.integers(0, 3000, 500)
    weight = np.full(500, 2.0)
    s = pitman_yor.opened(rng, count, weight, 0.5)
    after = np.maximum(count + rng.integers(-400, 400, 500), 0)
    t = pitman_yor.follow(rng, s, count, after, weight, 0.5)
    assert (np.bincount(t.owner, t.size, 500) == after).all()
    assert pitman_yor.follow(rng, s, count, np.zeros(500, int), weight, 0.5).size.sum() == 0
    # One customer more or less leaves the other tables as they were.
    big = pitman_yor.Seating(np.zeros(3, int), np.array([5, 9, 2]))
    one = pitman_yor.follow(rng, big, np.array([16]), np.array([15]), np.array([1.0]), 0.5)
    assert sum(abs(np.sort(one.size)[::-1][:2] - np.array([9, 5]))) <= 1 and one.size.sum() == 15


def test_every_context_has_a_restaurant_of_its_own(spark, monkeypatch):
    """More words than the head takes, all as frequent: all are rare. Each pair is
    learned once, so all texts have equal probability if no two contexts share."""
    monkeypatch.setattr(pitman_yor, "BUCKET_TOKENS", 40_000)  # several buckets
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.expr("concat('a', id, ' b', id)").alias("text"), F.lit(True).alias("train"))
    got = [r.score for r in pitman_yor.score(docs).collect()]
    assert len(got) == 40_000 and max(got) - min(got) < 1e-9


def test_buckets_know_all_of_their_contexts(spark, monkeypatch):
    """Tables and customers of contexts whose pairs lie in several buckets."""
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.6, 40) % 300) for _ in range(400)]
    rows = [(i, t.encode(), i % 5 != 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text binary, train boolean").repartition(3)
    monkeypatch.setattr(pitman_yor, "CHUNK_DOCS", 50)
    table = pitman_yor.dealt_table(pitman_yor.bucketed(pitman_yor.packed(docs, [b"w1"], 7), 7), 7).filter("bucket >= 0")
    first, shared = pitman_yor.first_counts(table, 7)
    after, _, later = pitman_yor.next_counts(pitman_yor.told(table, [shared]), 7, [first], None)
    whole = pitman_yor.told(table, [shared, later])
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    pairs = Counter()
    for _, t, learned in rows:
        words = t.split() if learned else []
        pairs.update(zip(words, [*words[1:], None]))
    customers, tables = Counter(), Counter()
    for (c, _), n in pairs.items():
        customers[c], tables[c] = customers[c] + n, tables[c] + 1
    names = {pitman_yor.xxhash.xxh64_intdigest(w): w for w in {w for _, t, _ in rows for w in t.split()}}
    seated, several = {}, 0
    for batch in whole.toArrow().to_batches():
        for k in range(batch.num_rows):
            b = pitman_yor._bucket(batch.slice(k, 1))
            learned = b.count > 0
            one = b.tables(first, 0, learned)[pitman_yor.RARE :]
            two = b.tables(after, 1, next(b.chain([first]))[0])[pitman_yor.RARE :]
            crowd = b.by_rare(b.count, b.guests)
            for key, x, y, n in zip(b.keys.tolist(), one, two, crowd):
                assert (x, n) == (tables[names[key]], customers[names[key]])
                assert seated.setdefault(key, y) == y >= x
            several += int(b.moving.sum())
    assert several > 100


def test_rounds_go_on_from_kept_seatings(spark, monkeypatch):
    """A round that is over is read, not worked out again, and gives the same."""
    texts = [" ".join(f"w{x}" for x in np.random.default_rng(i).zipf(1.6, 40) % 300) for i in range(120)]
    docs = spark.createDataFrame([(i, t.encode(), True) for i, t in enumerate(texts)], "doc_id long, text binary, train boolean")
    table = pitman_yor.dealt_table(pitman_yor.bucketed(pitman_yor.packed(docs, [b"w1"], 3), 3), 3).filter("bucket >= 0")
    first, shared = pitman_yor.first_counts(table, 3)
    after, _, later = pitman_yor.next_counts(pitman_yor.told(table, [shared]), 3, [first], None)
    rows = [b.slice(k, 1) for b in pitman_yor.told(table, [shared, later]).toArrow().to_batches() for k in range(b.num_rows)]
    assert len(rows) == 3
    plain = [pitman_yor._bucket(row) for row in rows]
    for b in plain:
        assert len(b.seatings) == 1
        b.seatings = []
    want = [list(b.chain([first, after])) for b in plain]
    assert all((seated[0][0] > 1).any() for seated in want)
    swept = []
    sweep = pitman_yor.sweep
    monkeypatch.setattr(pitman_yor, "sweep", lambda *a: swept.append(1) or sweep(*a))
    for row, both in zip(rows, want):
        got = pitman_yor._bucket(row).chain([first, after])
        assert all(np.array_equal(x, y) for x, y in zip(next(got), both[0])) and not swept
        assert all(np.array_equal(x, y) for x, y in zip(next(got), both[1])) and swept
        swept.clear()


def test_words_end_at_ascii_white_space():
    texts = [None, b"", b" a\x0bB\x1cc\xc2\x85 \xff\xe2\x80\x83D\n\n", b"\xc3\x84"]
    words = pitman_yor._words(pa.array(texts, pa.binary())).flatten().view(pa.binary()).to_pylist()
    assert [w for w in words if w] == [w for t in texts if t for w in t.lower().split()]


def test_odd_texts_are_scored(spark, odd, none):
    marked = odd.withColumn("train", F.when(F.col("doc_id") != 4, F.col("doc_id") % 3 != 0))
    got = pitman_yor.score(marked).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r.doc_id) for r in odd.collect())
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (1, 2, 3)) and all(math.isfinite(r.score) for r in got)
    assert pitman_yor.score(none.withColumn("train", F.lit(True))).count() == 0
    blank = pitman_yor.score(odd.withColumn("train", F.lit(False))).collect()
    assert {r.train_tokens for r in blank} == {0} and all(r.score == 0 for r in blank)


# ------------------------------------------------------------ pipeline


def test_stages(spark, odd, none):
    for docs in (odd, none):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            columns = docs.columns
            docs = corpus_pipeline.stored(stage(spark, docs, SF), "stage")
            assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns


def test_pipeline_matches_its_parts(spark):
    """Each stage against a plain version of it, on all its predecessor kept."""
    from test_duplicates_and_shards import fingerprint, roots
    from test_lines_and_index import hits

    read = spark.read.parquet(f"{SF}/documents.parquet")
    items = docs_of(spark.read.parquet(f"{SF}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    kept = [read]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(corpus_pipeline.stored(stage(spark, kept[-1], SF), name.split()[0]))
    clean, unique, fresh, masked, packed = ([*map(tuple, df.collect())] for df in kept[1:])
    assert 0.7 * read.count() < len(clean) < read.count()
    ordered = sorted(clean)
    least = roots([fingerprint(d[1]) for d in ordered])
    assert sorted(unique) == [d for i, d in enumerate(ordered) if least[i] == i]
    bad = {i for i, _, n, _ in hits([d[:2] for d in unique], items, 10) if n}
    assert bad and sorted(fresh) == sorted(d for d in unique if str(d[0]) not in bad)
    before = {d[0]: d for d in fresh}
    for d in masked:
        if not base(before[d[0]][1]):
            assert d == before[d[0]]
        assert not base(d[1]) and d[4] == len(d[1])
    assert sorted(p[:5] for p in packed) == sorted((d[0], *p) for d in masked for p in cut(d[1]))
