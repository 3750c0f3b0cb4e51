"""Line-first cleaning: rules judge single lines, failing lines go, and a
document goes if too much of it went with them.

A line (between ``\\n``) with a word fails if
  repeated     an earlier line of the document is equal to it;
  symbols      more than a tenth of its bytes, without spaces, are ``#*$%&|<>``;
  navigation   at least a fifth of its words are separators (``| > / -`` and the like);
  shouting     it has four words or more, over a quarter of its bytes are A-Z, and they
               are more than twice as many as a-z;
  stuttering   it has six words or more and over a third of them repeat the word before;
  boilerplate  it holds one of the fixed phrases of site furniture, in any case of A-Z;
  unfinished   it has eight words or more, and neither in it nor in the lines after it,
               up to the next line without words, does a word end in closing
               punctuation; lines in Thai or Lao, which have no such marks, never fail.
A sentence may thus run over any number of lines, as in text that was wrapped.
Lines without words are neither judged nor counted. A document is rejected by
the base figures (under 20 words, or over 30 % of its words in 8-word windows
that occur twice), or if the lines left hold less than half of its bytes.

Null and empty texts have no words and are rejected. Equal rows get equal
verdicts, and null ids stay null. Texts are judged whole; a batch holds a bounded
number of bytes. An empty table gives no rows; other columns, whatever their
names, are kept by ``clean`` and not read by ``assess``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import SPACES, free_name, small_batches

# Fixed values.
SYMBOLS = b"#*$%&|<>"
SEPARATORS = [b"|", b"||", b">", b">>", b"<", b"/", b"-", b"--", b"*", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2"]
PHRASES = [
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "skip to content",
    "back to top",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "click here to",
    "lorem ipsum",
    "share on facebook",
    "share on twitter",
    "powered by wordpress",
]
# Marks that close a sentence, in any script that has such marks, and what may follow them.
ENDINGS = [
    *".!?…:;\"')]}",
    *"”’»›」』）】",
    *"։؟۔܀܁܂।॥၊။።፧፨᙮᠃᠉។៕།༎。！？．｡：；‼‽⁇⁈⁉",
]
# First and last letter of the scripts that part sentences by spaces alone: Thai and Lao.
UNMARKED = ("\u0e01", "\u0eff")

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_PHRASE = re.compile("|".join(re.escape(p) for p in PHRASES).encode())
_ENDINGS = tuple(e.encode() for e in ENDINGS)
_UNMARKED = re.compile(b"\xe0(?:\xb8[\x81-\xbf]|[\xb9-\xbb][\x80-\xbf])")
_SEPARATORS = frozenset(SEPARATORS)

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
    " kept boolean, n_lines long, n_bad_lines long, cleaned binary"
)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur at least twice. Exact: word numbers are
    merged pairwise, and renumbered, until a number stands for a window."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    span = 1
    while span < window:
        step = min(span, window - span)
        ids = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        span += step
        order = np.argsort(ids, kind="stable")
        ranked = ids[order]
        first = np.empty(len(ranked), bool)
        first[0] = True
        np.not_equal(ranked[1:], ranked[:-1], out=first[1:])
        if first.all():
            return 0
        ids = np.empty(len(ranked), np.int64)
        ids[order] = np.cumsum(first) - 1
    starts = np.flatnonzero(np.bincount(ids)[ids] > 1)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(change)[:-1]))


def ended(words: list[bytes]) -> bool:
    return words[-1].endswith(_ENDINGS) or any(w.endswith(_ENDINGS) for w in words)


def failing(line: bytes, words: list[bytes], size: int, finished: bool) -> bool:
    """Whether a line fails. ``size``: its bytes without white space; ``finished``:
    it or a later line of its paragraph has closing punctuation."""
    n = len(words)
    if 10 * (len(line) - len(line.translate(None, SYMBOLS))) > size:
        return True
    if 5 * sum(w in _SEPARATORS for w in words) >= n:
        return True
    if n >= 4:
        upper = len(line) - len(line.translate(None, _UPPER))
        if 4 * upper > size and upper > 2 * (len(line) - len(line.translate(None, _LOWER))):
            return True
        if n >= 6 and 3 * sum(map(bytes.__eq__, words[1:], words)) > n:
            return True
        if n >= 8 and not finished and not _UNMARKED.search(line):
            return True
    return _PHRASE.search(line.lower()) is not None


def judge(text: bytes | None, with_text: bool = False) -> tuple:
    """The figures and the verdict of one text, in the order of ``SCHEMA``."""
    text = text or b""
    words = text.split()
    whole = len(text.translate(None, SPACES))
    points = len(text.decode("utf-8", "replace")) - (len(text) - whole)
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    lines = bad = dups = left = 0
    good: list[bytes] = []
    cut = [(line, line.split()) for line in text.split(b"\n")]
    finished, later = [False] * len(cut), False
    for i in range(len(cut) - 1, -1, -1):
        own = cut[i][1]
        finished[i] = later = bool(own) and (later or ended(own))
    for (line, own), done in zip(cut, finished):
        if not own:
            continue
        lines += 1
        size = len(line.translate(None, SPACES))
        if line in seen:
            dups += 1
            bad += 1
        elif failing(line, own, size, done):
            seen.add(line)
            bad += 1
        else:
            seen.add(line)
            left += size
            if with_text:
                good.append(line)
    repeats = repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * repeats > MAX_REPEAT_PERCENT * len(words)
    kept = not failed and 2 * left >= whole
    cleaned = b"\n".join(good) if with_text else None
    return len(words), points, symbols, dups, repeats, failed, kept, lines, bad, cleaned


_FIELDS = [f.split()[0] for f in SCHEMA.split(", ")]


def verdict(text: Column, with_text: bool = False) -> Column:
    """A struct of ``SCHEMA`` for a column of texts as bytes."""

    @F.pandas_udf(SCHEMA)
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([judge(t, with_text) for t in batch], columns=_FIELDS)

    return judged(text)


def assess(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, its figures and the verdict."""
    small_batches(docs.sparkSession)
    judged = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), verdict(F.col(f"`{text}`").cast("binary")).alias("v"))
    return judged.select("doc_id", *(f"v.{f}" for f in _FIELDS if f != "cleaned"))


def clean(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that pass, with all their columns and without failing lines."""
    small_batches(docs.sparkSession)
    name = free_name(docs, "verdict")
    judged = docs.withColumn(name, verdict(F.col(f"`{text}`").cast("binary"), True)).filter(F.col(f"`{name}`.kept"))
    return judged.withColumn(text, F.decode(F.col(f"`{name}`.cleaned"), "UTF-8")).drop(name)
