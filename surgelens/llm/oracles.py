"""SQL for the queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from surgelens.llm.license_join import PHRASES as LICENSE_PHRASES
from surgelens.llm.license_join import TEMPLATES, THRESHOLD, block_words, template_words
from surgelens.llm.linefirst import ENDINGS, MAX_REPEAT_PERCENT, MIN_WORDS, PHRASES, SEPARATORS, UNMARKED, WINDOW

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACED = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def quoted(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def ahead(n: int) -> str:
    """The next ``n`` words as one text; null near the end."""
    return " || ' ' || ".join(["word", *[f"lead(word, {k}) OVER p" for k in range(1, n)]])


LINE_FIRST = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(text, '{SPACED}') AS words FROM d),
pos AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
win AS (SELECT r, i, {ahead(WINDOW)} AS win FROM pos WINDOW p AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM win WHERE win IS NOT NULL) WHERE n > 1),
repeats AS (SELECT r, count(DISTINCT i + k) AS n FROM (SELECT r, i, unnest(range({WINDOW})) AS k FROM twice) GROUP BY r),
cut AS (SELECT r, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS n FROM d),
-- A paragraph ends at a line without words; what follows it in there can finish a line.
marked AS (
  SELECT r, n, line, regexp_matches(line, '{SPACED}') AS filled,
    len(list_filter(regexp_extract_all(line, '{SPACED}'), lambda x: right(x, 1) IN ({quoted(ENDINGS)}))) > 0 AS ended FROM cut),
paragraphs AS (SELECT *, sum(CASE WHEN filled THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY n) AS paragraph FROM marked),
closed AS (
  SELECT r, n, line, coalesce(bool_or(ended) OVER (PARTITION BY r, paragraph ORDER BY n DESC), false) AS finished
  FROM paragraphs WHERE filled),
lines AS (
  SELECT r, line, finished, row_number() OVER (PARTITION BY r, line ORDER BY n) > 1 AS dup,
    regexp_extract_all(line, '{SPACED}') AS ws, strlen(regexp_replace(line, '{BLANKS}', '', 'g')) AS size,
    strlen(line) - strlen(regexp_replace(line, '[#*$%&|<>]', '', 'g')) AS symbols,
    strlen(line) - strlen(regexp_replace(line, '[A-Z]', '', 'g')) AS upper,
    strlen(line) - strlen(regexp_replace(line, '[a-z]', '', 'g')) AS lower
  FROM closed),
judged AS (
  SELECT r, dup, size, dup OR 10 * symbols > size
    OR 5 * len(list_filter(ws, lambda x: x IN ({quoted([s.decode() for s in SEPARATORS])}))) >= len(ws)
    OR (len(ws) >= 4 AND 4 * upper > size AND upper > 2 * lower)
    OR (len(ws) >= 6 AND 3 * len(list_filter(range(1, len(ws)), lambda i: ws[i] = ws[i + 1])) > len(ws))
    OR (len(ws) >= 8 AND NOT finished AND NOT regexp_matches(line, '[{UNMARKED[0]}-{UNMARKED[1]}]'))
    OR regexp_matches({low('line')}, '{"|".join(PHRASES)}') AS bad
  FROM lines),
totals AS (
  SELECT r, count(*) AS n_lines, sum(CAST(bad AS INT)) AS n_bad_lines, sum(CAST(dup AS INT)) AS n_dup_lines,
    sum(CASE WHEN bad THEN 0 ELSE size END) AS held, sum(size) AS whole FROM judged GROUP BY r),
f AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '{BLANKS}', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_bad_lines, 0) AS BIGINT) AS n_bad_lines,
    coalesce(held, 0) AS held, coalesce(whole, 0) AS whole
  FROM w LEFT JOIN repeats USING (r) LEFT JOIN totals USING (r)),
g AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 2 * held >= whole AS kept, n_lines, n_bad_lines FROM g
"""


POSITIONAL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({low("coalesce(text, '')")}, '{PLAIN}') AS words FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({low('text')}, '{PLAIN}') AS words
  FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT item, words, unnest(range(1, greatest(1, len(words) - 9) + 1)) AS i FROM b WHERE len(words) > 0),
bwin AS (SELECT DISTINCT item, array_to_string(words[i:i + 9], ' ') AS win, least(10, len(words)) AS n FROM bw),
pos AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM d),
near AS (SELECT r, i, list(word) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ws FROM pos),
grams AS (SELECT r, i, n, array_to_string(ws[1:n], ' ') AS win FROM near, (SELECT DISTINCT n FROM bwin) WHERE len(ws) >= n),
occ AS (SELECT r, i, n, item FROM grams JOIN bwin USING (win, n)),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(n)) AS k FROM occ) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM occ WHERE item IS NOT NULL) GROUP BY r),
counts AS (SELECT word, count(*) AS n FROM pos GROUP BY word),
terms AS (
  SELECT item, word, n, row_number() OVER (PARTITION BY item ORDER BY n, word) AS k
  FROM (SELECT DISTINCT item, unnest(words) AS word FROM b WHERE item IS NOT NULL) LEFT JOIN counts USING (word)
  QUALIFY row_number() OVER (PARTITION BY item ORDER BY coalesce(n, 0), word) <= 4),
rare AS (SELECT item, word, k, count(*) OVER (PARTITION BY item) AS most FROM terms
  QUALIFY count(n) OVER (PARTITION BY item) = count(*) OVER (PARTITION BY item)),
centres AS (SELECT r, i, item, most FROM pos JOIN rare USING (word) WHERE k = 1),
beside AS (
  SELECT c.r, c.i, c.item, c.most, count(DISTINCT q.word) AS n FROM centres c
  LEFT JOIN rare o ON o.item = c.item AND o.k > 1
  LEFT JOIN pos q ON q.r = c.r AND q.word = o.word AND q.i BETWEEN c.i - 20 AND c.i + 20
  GROUP BY c.r, c.i, c.item, c.most),
close AS (SELECT r, count(DISTINCT item) AS n_near FROM beside WHERE n = most - 1 GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near_items
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r) LEFT JOIN close USING (r)
"""


def _templates() -> str:
    rows = []
    for t, (label, text, *share) in enumerate(TEMPLATES):
        words = template_words(text)
        least = (share or [THRESHOLD])[0]
        rows += [f"({t}, '{label}', '{w}', {len(words)}, {least}, {block_words(text, least)})" for w in words]
    return ", ".join(rows)


def _phrase(phrase: str) -> str:
    first, *rest = phrase.split()
    return " AND ".join([f"word = '{first}'", *[f"lead(word, {k + 1}) OVER p = '{w}'" for k, w in enumerate(rest)]])


_CASES = " ".join(f"WHEN {_phrase(p)} THEN '{label}'" for label, p in LICENSE_PHRASES.items())

LICENSES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all({low('text')}, '{PLAIN}') AS words FROM d),
pos AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS i FROM w),
named AS (SELECT r, i, CASE {_CASES} END AS label FROM pos WINDOW p AS (PARTITION BY r ORDER BY i)),
base AS (SELECT r, i, label FROM named WHERE label IS NOT NULL),
sums AS (SELECT r, count(*) AS n, min(i) AS first_word, max(i) AS last_word FROM base GROUP BY r),
t(t, label, word, size, least, span) AS (VALUES {_templates()}),
-- Texts that hold enough words of a template anywhere; then every run of ``span`` words in them.
near AS (SELECT r, t FROM pos JOIN t USING (word) GROUP BY r, t, size, least HAVING count(DISTINCT word) >= least * size - 1e-9),
tokens AS (SELECT r, t, i, word, label, size, least, span FROM pos JOIN t USING (word) JOIN near USING (r, t)),
held AS (
  SELECT a.r, a.t, a.i, a.label, a.size, a.least, count(DISTINCT b.word) AS held FROM tokens a
  JOIN tokens b ON a.r = b.r AND a.t = b.t AND b.i BETWEEN a.i AND a.i + a.span - 1 GROUP BY ALL),
own AS (SELECT r, label, held / size AS share FROM held WHERE held >= least * size - 1e-9),
best AS (SELECT r, max(share) AS share FROM own GROUP BY r),
base_list AS (SELECT r, string_agg(label, ',' ORDER BY label) AS list FROM (SELECT DISTINCT r, label FROM base) GROUP BY r),
all_list AS (SELECT r, string_agg(label, ',' ORDER BY label) AS list
  FROM (SELECT r, label FROM base UNION SELECT r, label FROM own) GROUP BY r)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(sums.n, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_list.list, '') AS base_labels, coalesce(all_list.list, '') AS labels,
  CASE WHEN sums.n > 0 THEN CAST(1 AS DOUBLE) ELSE coalesce(share, CAST(0 AS DOUBLE)) END AS score
FROM w LEFT JOIN sums USING (r) LEFT JOIN best USING (r) LEFT JOIN base_list USING (r) LEFT JOIN all_list USING (r)
"""


# CRC-32 bit by bit, over the bits of the decimal id, the lowest first.
_BITS = (
    "flatten(list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: list_transform(range(8),"
    " lambda b: (ascii(substr(CAST(c AS VARCHAR), i, 1)) >> b) & 1)))"
)
_CRC = (
    f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {_BITS}),"
    " lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"
)

PREFIX_TRIE = f"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS seq, {_CRC} % 6 AS h FROM t GROUP BY c),
built AS (
  SELECT a.c, list_concat(coalesce(b.seq[1:a.h], []), a.seq[a.h + 1:]) AS seq
  FROM own a LEFT JOIN own b ON b.c = a.c - a.c % 100),
member AS (SELECT c, d, seq[1:d] AS prefix, len(seq) = d AS ended FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM built)),
node AS (
  SELECT prefix, d, min(c) AS conv_id, count(*) AS n,
    coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ended), '') AS ends FROM member GROUP BY prefix, d),
kids AS (SELECT prefix[1:d - 1] AS prefix, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY 1, 2),
valued AS (
  SELECT node.*, coalesce(kids.n, 0) AS n_children, CASE WHEN kids.n IS NULL THEN 1 ELSE 0 END AS leaf,
    CASE WHEN node.d = 0 THEN 0 ELSE (node.n - 1) * length(prefix[len(prefix)].text) END AS saved
  FROM node LEFT JOIN kids USING (prefix, d)),
totals AS (
  SELECT prefix[1:a] AS prefix, a AS d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM valued) GROUP BY 1, 2)
SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(v.n AS BIGINT) AS n_convs,
  CAST(v.n_children AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued v JOIN totals USING (prefix, d) LEFT JOIN node p ON v.d > 0 AND p.d = v.d - 1 AND p.prefix = v.prefix[1:v.d - 1]
"""
