"""Personal data by a skip-chain conditional random field.

Base spans come from patterns: e-mail addresses, IP addresses, card numbers with
a valid check digit, phone numbers. The field labels tokens (between white
space) that hold a digit or ``@``; all other tokens can only be outside, so it
falls apart into short chains. Neighbouring tokens share transition potentials.
Tokens of a text that are equal, or share their last digits, share skip
potentials however far apart they are; in a group of such tokens each is linked
to the next, so the links grow with the tokens. A token's kind must also be
possible by its form (an IP address has four parts, a card a check digit, ...).
Loopy message passing over the whole text gives each token's beliefs; tokens
whose belief is ``SURE`` or more, outside the base spans, become further spans.

The weights are fitted to the base spans by pseudo-likelihood with left-out
features, on at most about ``TRAIN_DOCS`` documents, drawn by the hash of their
ids, and ``TRAIN_TOKENS`` tokens. Everything else covers all texts, whole.

Null and empty texts have no spans. Repeated rows are treated alike. If nothing
can be learned from, no spans are added to the base.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import free_name, raw, small_batches

TRAIN_DOCS = 50_000
TRAIN_TOKENS = 50_000
SURE = 0.9
ROUNDS = 20
# Tokens to either side whose digits count as one number with a token's own.
REACH = 5

# Kinds, in the order of spans with equal starts, and their patterns.
KINDS = ["email", "ip", "card", "phone"]
DOMAIN = r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

_DOMAIN = re.compile(DOMAIN)
# The same matches as ``IP``, without trying a long number from each of its digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD, _PHONE = re.compile(CARD), re.compile(PHONE)
_LOCAL = frozenset(LOCAL)
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_DIGIT = re.compile("[0-9]")
_EDGE = re.compile(r"^[^\w+(]+|[^\w)]+$")

LABELS = len(KINDS) + 1  # 0: outside
BUCKETS = 4096

Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def _small(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap, by start and kind."""
    found: list[Span] = []
    at, after = text.find("@"), 0
    while at >= 0:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            found.append((start, m.end(), 0))
            after = m.end()
        at = text.find("@", max(at + 1, after))
    if _DIGIT.search(text):
        found += [(*m.span(), 1) for m in _IP.finditer(text) if _small(m.group().split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
        found += [(*m.span(), 3) for m in _PHONE.finditer(text) if 10 <= len(_digits(m.group())) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


@dataclass
class Graph:
    """Tokens of some texts with their features, possible labels and links."""

    text: list[int]
    spans: list[tuple[int, int]]
    features: list[list[int]]
    possible: list[list[bool]]
    labels: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]

    @staticmethod
    def empty() -> "Graph":
        return Graph([], [], [], [], [], [], [])


def _shape(token: str) -> str:
    if "@" in token:
        return re.sub(r"[A-Za-z0-9_]+", "x", token)
    return re.sub(r"[0-9]+", lambda m: f"9{min(9, len(m.group()))}", re.sub(r"[^\W0-9_]+", "a", token))[:40]


def _bucket(*parts) -> int:
    return zlib.crc32("\x1f".join(map(str, parts)).encode("utf-8", "replace")) % BUCKETS


def add_text(graph: Graph, number: int, text: str, base: list[Span]) -> None:
    """Append the tokens of a text and their links."""
    first = len(graph.text)
    found = list(_TOKEN.finditer(text))
    runs: list[list[int]] = []
    cores = []
    for k, m in enumerate(found):
        token = m.group()
        core = _EDGE.sub("", token)
        start = m.start() + token.find(core) if core else m.start()
        cores.append((core or token, start, start + len(core or token)))
        joined = k and not text[found[k - 1].end() : m.start()].strip(" \t") and found[k - 1].end() < m.start()
        if joined:
            graph.chain.append((first + k - 1, first + k))
            runs[-1].append(k)
        else:
            runs.append([k])
    place = {k: (run, i) for run in runs for i, k in enumerate(run)}
    keyed: dict[tuple, list[int]] = {}
    b = 0
    for k, (core, start, end) in enumerate(cores):
        run, i = place[k]
        whole = "".join(cores[j][0] for j in run[max(0, i - REACH) : i + REACH + 1])
        digits, run_digits = _digits(core), _digits(whole)
        parts = core.split(".")
        four = len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts) and _small(parts)
        numeric = not core.strip("+().-0123456789")
        valid = 12 <= len(digits) <= 19 and luhn(digits) or 12 <= len(run_digits) <= 19 and luhn(run_digits)
        before = cores[k - 1][0] if i else ""
        after = cores[k + 1][0] if i + 1 < len(run) else ""
        shape = _shape(core)
        graph.features.append(
            [
                _bucket("shape", shape),
                _bucket("digits", len(digits)),
                _bucket("run", min(20, len(run_digits)), len(run) > 1),
                _bucket("plus", whole[:1] == "+", numeric),
                _bucket("before", _shape(before)),
                _bucket("after", _shape(after)),
                _bucket("at", "@" in core, len(parts)),
                _bucket("valid", valid, four, numeric),
                _bucket("all"),
            ]
        )
        graph.possible.append(
            [
                True,
                core.find("@") > 0 and "." in core.rpartition("@")[2].strip("."),
                four,
                bool(numeric and valid),
                numeric and not four and 7 <= len(run_digits) <= 15 and ("+" in whole or "(" in whole),
            ]
        )
        while b < len(base) and base[b][1] <= start:
            b += 1
        label = next((kind + 1 for s, e, kind in base[b : b + 4] if s < end and start < e), 0)
        graph.labels.append(label if graph.possible[-1][label] else 0)
        graph.text.append(number)
        graph.spans.append((start, end))
        plain = core.lower().strip("().-+")
        if len(plain) >= 3:
            keyed.setdefault(("same", plain), []).append(first + k)
        if len(digits) >= 7:
            keyed.setdefault(("tail", digits[-7:]), []).append(first + k)
    # A plain number can be a phone number if it repeats one that is written as such.
    for own in keyed.values():
        if any(graph.possible[i][4] for i in own):
            for i in own:
                if not cores[i - first][0].strip("+().-0123456789"):
                    graph.possible[i][4] = True
    links = {pair for own in keyed.values() for pair in zip(own, own[1:])}
    graph.skip += sorted(links - {(i, i + 1) for i, j in graph.chain[-len(found) - 1 :] if j == i + 1})


@dataclass
class Weights:
    unary: np.ndarray  # (BUCKETS, LABELS)
    chain: np.ndarray  # (LABELS, LABELS): left, right
    skip: np.ndarray  # symmetric


def _pairs(pairs: list[tuple[int, int]]) -> np.ndarray:
    return np.array(pairs, np.int64).reshape(-1, 2)


def fit(graph: Graph, steps: int = 150, rate: float = 0.1, dropped: float = 0.3) -> Weights:
    """Pseudo-likelihood by Adam; a part of the features is left out in each step,
    so that links carry what a token's own form doesn't show."""
    rng = np.random.default_rng(0)
    n = len(graph.labels)
    w = Weights(np.zeros((BUCKETS, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    if not n:
        return w
    features, labels = np.array(graph.features), np.array(graph.labels)
    barred = np.where(np.array(graph.possible), 0.0, -1e9)
    one = np.eye(LABELS)[labels]
    left, right, skip = (np.zeros((n, LABELS)) for _ in range(3))
    chain, links = _pairs(graph.chain), _pairs(graph.skip)
    np.add.at(left, chain[:, 1], one[chain[:, 0]])
    np.add.at(right, chain[:, 0], one[chain[:, 1]])
    np.add.at(skip, links[:, 0], one[links[:, 1]])
    np.add.at(skip, links[:, 1], one[links[:, 0]])
    params = [w.unary, w.chain, w.skip]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        shown = (rng.random(features.shape) >= dropped)[..., None]
        logits = (w.unary[features] * shown).sum(1) + left @ w.chain + right @ w.chain.T + skip @ w.skip + barred
        p = np.exp(logits - logits.max(1, keepdims=True))
        error = (p / p.sum(1, keepdims=True) - one) / n
        unary = np.zeros_like(w.unary)
        np.add.at(unary, features.ravel(), (error[:, None, :] * shown).reshape(-1, LABELS))
        link = skip.T @ error
        for k, grad in enumerate([unary, left.T @ error + (right.T @ error).T, (link + link.T) / 2]):
            grad = grad + 1e-4 * params[k] / max(1, n / 1000)
            first[k] = 0.9 * first[k] + 0.1 * grad
            second[k] = 0.999 * second[k] + 0.001 * grad**2
            params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return w


def beliefs(graph: Graph, w: Weights, rounds: int | None = None) -> np.ndarray:
    """Sum-product messages along all links at once, damped, until they rest.

    Every text's messages rest on their own, so its beliefs don't depend on which
    texts it is handled with. Messages that don't come to rest are ended, by
    default, ``ROUNDS`` rounds after they could have passed along all skip links of
    the text that has most of them.
    """
    linked = Counter(graph.text[i] for i, _ in graph.skip)
    rounds = ROUNDS + max(linked.values(), default=0) if rounds is None else rounds
    unary = w.unary[np.array(graph.features)].sum(1) + np.where(np.array(graph.possible), 0.0, -1e9)
    chain, skip = _pairs(graph.chain), _pairs(graph.skip)
    source = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    target = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    c, s = len(chain), len(skip)
    back = np.concatenate([np.arange(c) + c, np.arange(c), 2 * c + s + np.arange(s), 2 * c + np.arange(s)])
    score = np.concatenate([np.repeat(m[None], k, 0) for m, k in ((w.chain, c), (w.chain.T, c), (w.skip, 2 * s))])
    sent = np.zeros((len(source), LABELS))
    of_text = np.array(graph.text, np.int64)[source] if len(source) else np.zeros(0, np.int64)
    moving = np.ones(int(of_text.max()) + 1 if len(source) else 0, bool)

    def gathered() -> np.ndarray:
        b = unary.copy()
        np.add.at(b, target, sent)
        return b

    for _ in range(rounds if len(source) else 0):
        on = np.flatnonzero(moving[of_text])
        lacking = (gathered()[source[on]] - sent[back[on]])[:, :, None] + score[on]
        top = lacking.max(1)
        new = top + np.log(np.exp(lacking - top[:, None]).sum(1))
        new = 0.7 * (new - new.max(1, keepdims=True)) + 0.3 * sent[on]
        change = np.zeros(len(moving))
        np.maximum.at(change, of_text[on], np.abs(new - sent[on]).max(1))
        sent[on] = new
        moving &= change >= 1e-4
        if not moving.any():
            break
    b = gathered()
    p = np.exp(b - b.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(graph: Graph, found: np.ndarray, base: dict[int, list[Span]]) -> dict[int, list[Span]]:
    """Sure tokens outside the base spans; the parts of a phone number make one span."""
    kinds = found.argmax(1)
    sure = (kinds > 0) & (found.max(1) >= SURE)
    joined = {j for i, j in graph.chain if sure[i] and sure[j] and kinds[i] == kinds[j]}
    spans: dict[int, list[Span]] = {}
    for i in np.flatnonzero(sure).tolist():
        (start, end), own = graph.spans[i], spans.setdefault(graph.text[i], [])
        if i in joined and own and kinds[i] == 4 and own[-1][2] == 3:
            own[-1] = (own[-1][0], end, own[-1][2])
        else:
            own.append((start, end, int(kinds[i]) - 1))
    clear = lambda s, others: not any(a < s[1] and s[0] < b for a, b, _ in others)
    return {t: [s for s in own if clear(s, base.get(t, []))] for t, own in spans.items()}


def find(texts: list[str | None], w: Weights | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of every text."""
    graph, base = Graph.empty(), {}
    for k, text in enumerate(texts):
        if text and ("@" in text or _DIGIT.search(text)):
            base[k] = base_spans(text)
            if w is not None:
                add_text(graph, k, text, base[k])
    more = added_spans(graph, beliefs(graph, w), base) if graph.labels else {}
    order = lambda s: (s[0], s[2])
    return [(base.get(k, []), sorted(base.get(k, []) + more.get(k, []), key=order)) for k in range(len(texts))]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Weights | None:
    """Weights from a bounded sample of ``docs``; None if it has no token to learn from."""
    small_batches(docs.sparkSession)
    own = raw(docs, text, doc_id=doc_id)
    share = min(1.0, TRAIN_DOCS / max(1, own.count()))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    sample = own.filter(drawn & F.col("text").cast("string").rlike("[0-9@]"))

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text").to_pylist():
                body, graph = value.decode("utf-8", "replace"), Graph.empty()
                add_text(graph, 0, body, base_spans(body))
                rows.append((hashlib.md5(value).hexdigest(), len(graph.labels), graph))
            values = [
                pa.array([r[0] for r in rows], pa.string()),
                pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2].features for r in rows], pa.list_(pa.list_(pa.int32()))),
                pa.array([r[2].possible for r in rows], pa.list_(pa.list_(pa.bool_()))),
                pa.array([r[2].labels for r in rows], pa.list_(pa.int32())),
                pa.array([r[2].chain for r in rows], pa.list_(pa.list_(pa.int32()))),
                pa.array([r[2].skip for r in rows], pa.list_(pa.list_(pa.int32()))),
            ]
            yield pa.RecordBatch.from_arrays(values, ["digest", "n", "features", "possible", "labels", "chain", "skip"])

    schema = (
        "digest string, n long, features array<array<int>>, possible array<array<boolean>>, labels array<int>,"
        " chain array<array<int>>, skip array<array<int>>"
    )
    # Texts with more tokens than all others may have together teach nothing more.
    found = sample.mapInArrow(tokens, schema).filter(f"n > 0 AND n <= {TRAIN_TOKENS // 10}")
    graph = Graph.empty()
    for r in found.orderBy("digest").limit(TRAIN_TOKENS // 10).toLocalIterator():
        at = len(graph.labels)
        if at + r["n"] > TRAIN_TOKENS:
            break
        graph.features += r["features"]
        graph.possible += r["possible"]
        graph.labels += r["labels"]
        graph.chain += [(i + at, j + at) for i, j in r["chain"]]
        graph.skip += [(i + at, j + at) for i, j in r["skip"]]
    return fit(graph) if graph.labels else None


SCHEMA = "base array<struct<start:int,end:int,kind:string>>, spans array<struct<start:int,end:int,kind:string>>"


def spans(text: Column, w: Weights | None) -> Column:
    """A struct of base spans and all spans, in code points, for a column of texts."""
    named = lambda found: [{"start": s, "end": e, "kind": KINDS[k]} for s, e, k in found]

    @F.pandas_udf(SCHEMA)
    def marked(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = find([t if isinstance(t, str) else None for t in batch], w)
            yield pd.DataFrame({"base": [named(b) for b, _ in found], "spans": [named(s) for _, s in found]})

    return marked(text)


def detect(docs: DataFrame, w: Weights | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, base, spans of every row of ``docs``."""
    small_batches(docs.sparkSession)
    found = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), spans(F.col(f"`{text}`"), w).alias("found"))
    return found.select("doc_id", "found.base", "found.spans")


def redact(docs: DataFrame, w: Weights | None, text: str = "text") -> DataFrame:
    """``docs`` with a mark such as ``<EMAIL>`` in place of every span; spans that
    overlap share a mark."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            texts = [t if isinstance(t, str) else None for t in batch]
            out = []
            for body, (_, found) in zip(texts, find(texts, w)):
                parts, at = [], 0
                for s, e, k in found:
                    if s >= at:
                        parts += [body[at:s], f"<{KINDS[k].upper()}>"]
                    at = max(at, e)
                out.append("".join(parts) + body[at:] if found else body)
            yield pd.Series(out, dtype=object)

    name = free_name(docs, "masked")
    return docs.withColumn(name, masked(F.col(f"`{text}`"))).withColumn(text, F.col(name)).drop(name)
