"""SimHash blocks, components, sampled splitters and quotation linking."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from surgelens.llm import queries, quotes, simhash, splitters
from surgelens.llm.components import components

SF = "/root/testdata/sf0.001"


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(values, max_bits=3):
    """The least index of each value's component, over all pairs."""
    a, parent = np.array(values, np.uint64), list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(a)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= max_bits) + i + 1:
            x, y = sorted((find(i), find(int(j))))
            parent[y] = x
    return [find(i) for i in range(len(a))]


def test_fingerprints_and_components_match_brute_force(spark, odd):
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        docs = sorted(((r.doc_id is None, r.doc_id, r.text) for r in df.collect()), key=str)
        docs.sort(key=lambda d: (d[0], d[1] or 0))
        prints = [fingerprint(t) for _, _, t in docs]
        want = sorted(str((d[1], p, docs[r][1])) for d, p, r in zip(docs, prints, roots(prints)))
        got = simhash.near_duplicates(df).collect()
        assert sorted(str((r.doc_id, r.fp % 2**64, r.component_id)) for r in got) == want


def near(rng, value, bits):
    return value ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, bits)))


@pytest.mark.parametrize("blocks,crowd", [(4, 2048), (5, 2048), (6, 4), (4, 2), (None, 16)])
def test_classes_of_random_crowds(spark, blocks, crowd):
    """Crowds of near copies, also when every key is over-full and is cut anew."""
    rng = random.Random(3)
    centres = [rng.getrandbits(64) for _ in range(6)]
    values = sorted({near(rng, c, 5) for c in centres for _ in range(40)} | {rng.getrandbits(64) for _ in range(60)})
    df = spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp long")
    found = dict(map(tuple, simhash.classes(df, 3, blocks, crowd).collect()))
    want = roots(values)
    groups, got = defaultdict(set), defaultdict(set)
    for v, r in zip(values, want):
        signed = int(np.uint64(v).view(np.int64))
        groups[r].add(signed)
        got[found.get(signed, signed)].add(signed)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, got.values()))


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)] + [(1000, 1000 + k) for k in range(1, 300)] + [(5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(path, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(1, 201)} | {1000 + k: 1000 for k in range(1, 300)}


def test_deduplicate_keeps_one_of_each(spark, odd, none):
    left = simhash.deduplicate(odd)
    assert left.columns == odd.columns
    got = [r.doc_id for r in left.collect()]
    # 1, 2, 3 and a nameless row have no words; 4 and 5 are equal; a nameless row is near them.
    named = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).collect()}
    assert sorted(i for i in got if i is not None) == sorted({c for c in named.values() if c is not None})
    assert simhash.deduplicate(none).count() == 0
    lone = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "x y z")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.deduplicate(lone).collect()) == ["a b c d", "x y z"]


def balance(found):
    sizes, slots = Counter(), defaultdict(list)
    for r in found:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return sizes


def test_shards_are_even_and_whole(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = dict(map(tuple, df.select("doc_id", "text").collect()))
    found = splitters.assign(df).collect()
    sizes = balance(found)
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.01 * min(sizes.values())
    shards = defaultdict(set)
    for r in found:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(body) + 1, zlib.crc32(body))
        shards[body].add(r.shard)
    assert len(found) == len(texts) and all(len(s) == 1 for s in shards.values())


def test_a_text_that_is_a_third_of_all_is_subdivided(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("x" * 500)).otherwise(F.concat(F.lit("t"), "id", F.repeat(F.lit("y"), 400)))
    sizes = balance(splitters.assign(spark.range(3000).select(F.col("id").alias("doc_id"), hot.alias("text")), ranges=128).collect())
    assert max(sizes.values()) < 1.02 * min(sizes.values())


def test_groups_of_equal_texts_are_cut_where_the_law_asks(spark):
    """Twelve groups of equal size can't lie whole in eight shards of equal size."""
    rows = spark.range(1200).selectExpr("id AS doc_id", "repeat(concat('g', id % 12), 200) AS text")
    sizes = balance(splitters.assign(rows).collect())
    assert len(sizes) == 8 and max(sizes.values()) < 1.02 * min(sizes.values())


def test_repeats_of_one_row_are_spread(spark):
    same = spark.range(900).selectExpr("CAST(7 AS bigint) AS doc_id", "repeat('same ', 90) AS text")
    nameless = spark.range(600).selectExpr("CAST(NULL AS bigint) AS doc_id", "repeat('none ', 90) AS text")
    other = spark.range(2000).selectExpr("id AS doc_id", "concat('t', id, repeat('y', 400)) AS text")
    found = splitters.assign(same.union(nameless).union(other)).collect()
    sizes = balance(found)
    assert len(found) == 3500 and max(sizes.values()) < 1.02 * min(sizes.values())
    assert len({r.shard for r in found if r.doc_id == 7}) > 1 and len({r.shard for r in found if r.doc_id is None}) > 1


def largest_first(sizes, shards):
    filled = [0] * shards
    for size in sorted(sizes, reverse=True):
        filled[filled.index(min(filled))] += size
    return filled


def test_shards_are_as_even_as_records_dealt_one_by_one(spark):
    rnd = random.Random(8)
    texts = ["x" * rnd.randint(1, 4000) for _ in range(700)] + ["hot" * 300] * 400 + [None] * 50
    found = splitters.assign(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").repartition(5)).collect()
    sizes, best = balance(found), largest_first([r.size for r in found], 8)
    assert max(sizes.values()) <= max(best) * 1.01 and min(sizes.values()) >= min(best) * 0.99


def test_odd_rows_are_placed(odd, none):
    found = splitters.assign(odd).collect()
    balance(found)
    assert len(found) == odd.count() and sorted(r.size for r in found)[:3] == [1, 1, 1]
    assert splitters.assign(none).count() == 0


def test_written_shards(spark, odd, fresh):
    path = fresh("shards")
    splitters.write(odd, path)
    back = spark.read.parquet(path)
    assert sorted(str(r[:2]) for r in back.select(*odd.columns).collect()) == sorted(str(r[:2]) for r in odd.collect())
    slots = defaultdict(list)
    for r in back.collect():
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def mail(spark, rows):
    return {r.id: r for r in quotes.conversations(spark.createDataFrame(rows, "id long, text string")).collect()}


def test_links_levels_and_wrapping(spark):
    got = mail(
        spark,
        [
            (1, "A first question about\nthe thing."),
            (2, "> A first question\n> about the thing.\n\nAn answer to it."),
            (3, ">> A first question about the thing.\n> An  ANSWER to it.\n\nThanks!"),
            (4, "> > An answer to it.\nJumping in here."),  # only a deeper level is linked
            (5, "> never said\nNew topic"),
            (6, None),
        ],
    )
    parents = {i: r.parent_id for i, r in got.items()}
    assert parents == {1: None, 2: 1, 3: 2, 4: 2, 5: None, 6: None}
    assert [got[i].text for i in range(1, 6)] == ["A first question about\nthe thing.", "An answer to it.", "Thanks!", "Jumping in here.", "New topic"]
    assert [(got[i].root_id, got[i].depth, got[i].position) for i in (1, 2, 3, 4)] == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (1, 2, 3)]


def test_latest_earlier_original_wins(spark):
    rows = [(i, "Same words.") for i in range(0, 40, 2)] + [(i, "> Same words.\nreply") for i in range(1, 40, 2)]
    got = mail(spark, rows)
    assert all(got[i].parent_id == i - 1 for i in range(1, 40, 2))


def test_long_chain_and_crowd(spark):
    chain = [(0, "start")] + [(i, f"> {'start' if i == 1 else f'note {i - 1}'}\nnote {i}") for i in range(1, 70)]
    crowd = [(1000 + i, "> start\nme too") for i in range(500)]
    got = mail(spark, chain + crowd)
    assert got[69].depth == 69 and all(r.root_id == 0 for r in got.values())
    assert sorted(r.position for r in got.values()) == list(range(570))


def test_odd_messages(spark, odd, none):
    found = quotes.conversations(odd, "doc_id").collect()
    assert Counter(r.id for r in found) == Counter([1, 2, 3, 4, 5, 6, 7, 8, None, None])
    assert quotes.conversations(none, "doc_id").count() == 0


def test_every_row_is_a_message(spark, fresh):
    """Long conversations, null keys, shared turns and repeated rows lose nothing."""
    rows = [(1, t, "user", f"turn {t} of it") for t in range(1030)]
    rows += [(2, 0, "user", "hello there"), (2, 1, "user", "and again"), (None, 0, "user", "no home"), (None, None, None, None)]
    rows += [(3, 0, "user", "one"), (3, 0, "user", "two"), (3, None, "user", "first"), (3, 0, "user", "two")]
    folder = fresh("mail")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{folder}/conversations.parquet")
    got = queries.QUERIES["op1_quotation_linking"](spark, folder).collect()
    assert Counter((r.conv_id, r.turn) for r in got) == Counter(r[:2] for r in rows)
    assert sorted(r.message_id for r in got) == list(range(len(rows)))
    by_id = {r.message_id: r for r in got}
    for r in got:
        above = by_id.get(r.message_id - 1)
        linked = above is not None and r.conv_id is not None and above.conv_id == r.conv_id
        assert r.parent_id == (above.message_id if linked else None)
    texts = Counter(r.text_sha256 for r in got)
    assert texts == Counter(hashlib.sha256((r[3] or "").encode()).hexdigest() for r in rows)


def test_stretches_follow_the_messages_not_the_ids(spark):
    ids = spark.range(20_000).union(spark.createDataFrame([(1 << 60,)], "id long"))
    bounds = quotes.stretch_bounds(ids)
    assert len(bounds) > 3500
    most = quotes._stretched(ids, bounds).groupBy("stretch").count().agg(F.max("count")).first()[0]
    assert most < 20


def brute_links(messages):
    """Own and quoted passages by hand: the parent is the lowest linked level's target."""
    own, parents = defaultdict(list), {}
    for i, text in sorted(messages):
        found, run, last = [], [], None
        for line in [*(text or "").split("\n"), None]:
            marks = re.match(r"^(?:>[ \t]?)+", line or "")
            level, body = (marks[0].count(">") if marks else 0), (line or "")[marks.end() if marks else 0 :]
            if run and (line is None or not body.strip(" ") or level != last):
                found.append((last, " ".join(" ".join(run).split()).lower()))
                run = []
            if line is not None and body.strip(" "):
                run.append(body)
            last = level
        votes = defaultdict(int)
        for level, words in found:
            if level and own[words]:
                votes[level, own[words][-1]] += len(words)
        parents[i] = max(votes, key=lambda k: (-k[0], votes[k], k[1]))[1] if votes else None
        for level, words in found:
            if level == 0:
                own[words].append(i)
    return parents


def test_arbitrary_quotations_match_brute_force(spark):
    rnd = random.Random(9)
    phrases = [f"phrase {k} says Something" for k in range(12)]
    rows = []
    for i in range(400):
        parts = []
        for _ in range(rnd.randint(0, 5)):
            level = rnd.choice([0, 0, 1, 1, 2, 3])
            words = rnd.choice(phrases).split()
            cut = rnd.randint(1, len(words))
            for half in (words[:cut], words[cut:]):
                if half:
                    parts.append("> " * level + rnd.choice([" ", "  "]).join(half))
            parts += [""] * rnd.randint(0, 1)
        rows.append((i * rnd.choice([7]), "\n".join(parts) if rnd.random() < 0.95 else None))
    got = {r.id: r.parent_id for r in quotes.conversations(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got == brute_links(rows) and sum(p is not None for p in got.values()) > 150
