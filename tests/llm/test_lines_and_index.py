"""Line-first cleaning, the positional index and the license join."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import surgelens.llm.positional as P
from surgelens.llm import license_join as L
from surgelens.llm import linefirst, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def docs_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


# ------------------------------------------------------------ line-first cleaning


def figures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + k for own in windows.values() if len(own) > 1 for i in own for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


def test_figures_match_brute_force(spark, odd):
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        got = linefirst.assess(df).collect()
        want = sorted((str(i), *figures(t)) for i, t in docs_of(df))
        assert sorted((str(r[0]), *r[1:7]) for r in got) == want
        assert not any(r["kept"] and r["base_failed"] for r in got)


@pytest.mark.parametrize(
    "line",
    [
        "Home | News | Sport | Contact",
        "aa** bb## cc$$ dd%% ee",
        "BUY NOW WHILE STOCK LASTS TODAY",
        "spam spam spam spam spam spam.",
        "See our Privacy Policy.",
        "one two three four five six seven eight nine",
    ],
)
def test_bad_lines(line):
    raw = line.encode()
    assert linefirst.failing(raw, raw.split(), len(raw.translate(None, b" ")), linefirst.ended(raw.split()))


def test_good_lines():
    for line in ("A plain sentence, with a comma.", "Titel", "¿Qué pasa en la calle de la casa ahora?", "USA и СССР в прошлом веке."):
        raw = line.encode()
        assert not linefirst.failing(raw, raw.split(), len(raw.translate(None, b" ")), linefirst.ended(raw.split()))


PROSE = (
    "The harbour was quiet that morning, and the boats lay still on the water while the fog came in from the west. "
    "Nobody had seen the keeper since the storm, so two of the older men rowed out to the light to look for him. "
    "They found the lamp trimmed and the log written up to the evening before, but the chair by the stove was empty. "
) * 3


@pytest.mark.parametrize("columns", [30, 80, 200])
def test_wrapped_prose_is_left_alone(columns):
    import textwrap

    sentences = {s: i for i, s in enumerate(PROSE.split(". "))}
    text = ". ".join(f"{i} {s}" for s, i in sentences.items())
    wrapped = "\n".join(textwrap.wrap(text, columns))
    got = dict(zip(linefirst._FIELDS, linefirst.judge(wrapped.encode(), True)))
    assert got["kept"] and got["n_bad_lines"] == 0 and got["cleaned"] == wrapped.encode()


def test_clean_text_of_other_scripts_is_left_alone():
    hindi = "\n".join(f"यह {i} एक साफ़ वाक्य है जो हिन्दी में ठीक से लिखा गया है।" for i in range(20))
    arabic = "\n".join(f"هل كتبت {i} هذه الجملة النظيفة بشكل صحيح باللغة العربية اليوم؟" for i in range(20))
    thai = "\n".join(f"นี่ คือ {i} ประโยค ที่ สะอาด และ เขียน ถูกต้อง ใน ภาษา ไทย" for i in range(20))
    for text in (hindi, arabic, thai):
        got = dict(zip(linefirst._FIELDS, linefirst.judge(text.encode())))
        assert got["n_bad_lines"] == 0 and got["kept"] == (not got["base_failed"])


def test_a_list_without_any_mark_is_unfinished():
    lines = [f"{i} one two three four five six seven eight" for i in range(5)]
    assert dict(zip(linefirst._FIELDS, linefirst.judge("\n".join(lines).encode())))["n_bad_lines"] == 5
    ended = "\n".join([*lines, "The end.", "", "a b c d e f g h"])
    assert dict(zip(linefirst._FIELDS, linefirst.judge(ended.encode())))["n_bad_lines"] == 1


def test_clean_takes_lines_out_and_keeps_columns(spark, odd, none):
    good = "A plain sentence, with a comma and enough words to be kept by the rule on length, it seems. Yes, it does."
    more = "Another line follows."
    text = f"{good}\nHome | News | Sport\n{more}\n{more}"
    df = spark.createDataFrame([(1, text, "x")], "doc_id int, text string, verdict string")
    row = linefirst.clean(df).first()
    assert row["text"] == f"{good}\n{more}" and row["verdict"] == "x"
    assert linefirst.clean(odd).columns == odd.columns
    assert linefirst.clean(none).count() == 0 and linefirst.assess(none).count() == 0


def test_labelled_quality(spark):
    got = queries.QUERIES["op10_line_first_cleaning"](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    n = got.filter("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    shares = dict(map(tuple, n))
    assert shares[1] > 0.99 and shares.get(0, 0) < 0.1


# ------------------------------------------------------------ positional index


def hits(docs, items, window):
    windows = {}
    for item, text in items:
        words = WORD.findall(low(text))
        for k in range(max(1, len(words) - window + 1) if words else 0):
            windows.setdefault(tuple(words[k : k + window]), set()).update([] if item is None else [str(item)])
    out = []
    for i, text in docs:
        words, hit, own = WORD.findall(low(text)), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                if tuple(words[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    own |= windows[tuple(words[k : k + n])]
        out.append((str(i), len(words), len(hit), sorted(own)))
    return sorted(out)


def rows(found):
    return sorted((str(r.doc_id), r.n_words, sum(s.after - s.first for s in r.spans), r["items"]) for r in found.collect())


def test_hits_match_brute_force(spark, odd):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    df = spark.read.parquet(f"{SF}/documents.parquet")
    assert rows(P.contamination(df, bench)) == hits(docs_of(df), items, 10)
    own = [(1, "that ends well. It has"), (2, None), (3, ""), (4, "and12 word35 AND0, word36"), (5, "é ü ñ 日本"), (None, "text that")]
    few = spark.createDataFrame(own, "item_id long, text string")
    assert rows(P.contamination(odd, few, window=3)) == hits(docs_of(odd), own, 3)


def test_blocks_of_items_are_merged(spark, odd, monkeypatch):
    own = [(k, f"word{k} and{k % 13} word{k + 1}") for k in range(40)]
    items = spark.createDataFrame(own, "item_id long, text string")
    df = odd.filter("doc_id = 7").union(odd.filter("doc_id = 4"))
    whole = rows(P.contamination(df, items, window=3))
    monkeypatch.setattr(P, "BLOCK_WORDS", 50)
    assert rows(P.contamination(df, items, window=3)) == whole == hits(docs_of(df), own, 3)


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "gamma " + "x " * 30 + "alpha beta")], "doc_id int, text string")
    items = spark.createDataFrame([("i", "gamma beta alpha")], "item_id string, text string")
    got = {r.doc_id: r.near_items for r in P.contamination(docs, items, window=3, near_terms=3, slop=5).collect()}
    assert got == {1: ["i"], 2: []}


def test_uncontaminated(spark, odd, none):
    items = spark.createDataFrame([(1, "that ends well it has")], "item_id long, text string")
    left = P.uncontaminated(odd, items)
    assert left.columns == odd.columns
    assert sorted(map(str, docs_of(left))) == sorted(str(d) for d in docs_of(odd) if "ends well" not in (d[1] or ""))
    assert P.uncontaminated(none, items).count() == 0
    assert P.uncontaminated(odd, items.filter("false")).count() == odd.count()
    nameless = spark.createDataFrame([(None, "that ends well it has")], "item_id long, text string")
    assert P.uncontaminated(odd, nameless).count() == left.count() < odd.count()
    spans = P.contamination(odd, nameless).filter("size(spans) > 0")
    assert spans.count() > 0 and spans.filter("size(items) > 0 OR size(near_items) > 0").count() == 0


# ------------------------------------------------------------ license join


def scanned(text, templates=L.TEMPLATES):
    words, at = WORD.findall(low(text)), {}
    for label, phrase in L.PHRASES.items():
        p = phrase.split()
        at[label] = [i for i in range(len(words)) if words[i : i + len(p)] == p]
    places, base = sorted(sum(at.values(), [])), {k for k, v in at.items() if v}
    own, best = set(), 0.0
    for label, body, *share in templates:
        least, t = (share or [L.THRESHOLD])[0], set(L.template_words(body))
        if len(t.intersection(words)) < least * len(t) - 1e-9:
            continue
        for i in range(len(words)):
            held = len(t.intersection(words[i : i + L.block_words(body, least)]))
            if held >= least * len(t) - 1e-9:
                own.add(label)
                best = max(best, held / len(t))
    ends = (places[0], places[-1]) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(base | own)), 1.0 if places else best)


def test_scan_matches_brute_force(spark, odd, none):
    for df in (odd, spark.read.parquet(f"{SF}/documents.parquet")):
        got = sorted(str((r[0], *r[1:8])) for r in L.scan(df).collect())
        assert got == sorted(str((i, *scanned(t))) for i, t in docs_of(df))
    assert L.scan(none).count() == 0


def test_random_blocks(spark):
    import random

    r = random.Random(5)
    templates = [(f"t{k}", " ".join(r.sample([f"w{i}" for i in range(30)], r.randint(3, 12)))) for k in range(12)]
    templates += [(f"r{k}", " ".join(r.choices([f"w{i}" for i in range(9)], k=12))) for k in range(4)]
    lines = [" ".join(r.choices([f"w{i}" for i in range(40)], k=r.randint(0, 25))) for _ in range(900)]
    texts = ["\n".join(lines[i : i + 3]) for i in range(0, 900, 3)]
    texts += [" ".join(r.choices([f"w{i}" for i in range(11)], k=40)) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {x.doc_id: x["labels"] for x in L.scan(df, templates=templates).collect()}
    assert got == {i: scanned(t, templates)[5] for i, t in enumerate(texts)} and any(got.values())


@pytest.mark.parametrize("columns", [20, 76, 10_000])
def test_wrapped_notices_are_found(spark, columns):
    import textwrap

    prose = "The harbour was quiet that morning and the boats lay still on the water. "
    texts = []
    for _, body, *_ in L.TEMPLATES:
        notice = textwrap.wrap(body, columns)
        texts += ["\n".join([prose, *notice, prose]), "\n".join([" * " + x for x in notice]), prose * 3 + body.upper() + prose]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r for r in L.scan(df).collect()}
    for i, text in enumerate(texts):
        label = L.TEMPLATES[i // 3][0]
        assert label in got[i]["labels"].split(",") and got[i]["score"] >= 0.9
        assert (len(WORD.findall(low(text))), got[i]["labels"]) == (scanned(text)[0], scanned(text)[5])
    first = [b for b in got[0]["blocks"] if b["label"] == L.TEMPLATES[0][0]][0]["first"]
    assert first == len(prose.split())


def test_only_ascii_letters_are_folded(spark):
    kelvin = "Released under the MIT License.".replace("L", "\u212a").replace("I", "\u0130")
    template = [("k", "kilo under the mit license")]
    df = spark.createDataFrame([(1, kelvin), (2, "\u212ailo under the mit license"), (3, "Kilo UNDER the MIT license")], "doc_id int, text string")
    got = {r.doc_id: r for r in L.scan(df, templates=template, threshold=1.0).collect()}
    assert [got[i]["base_labels"] for i in (1, 2, 3)] == ["", "mit", "mit"]
    assert [got[i]["labels"] for i in (1, 2, 3)] == ["", "mit", "k,mit"]


def test_plan_has_no_python(spark):
    plan = L.scan(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_item_digest(spark):
    got = queries.QUERIES["op7_positional_index"](spark, SF).filter("n_items = 0").first()
    assert got["items_sha256"] == hashlib.sha256(b"").hexdigest()
