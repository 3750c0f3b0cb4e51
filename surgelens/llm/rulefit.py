"""A quality classifier of sparse rules: tree paths, lasso weights, Spark expressions.

Every text is described by the figures in ``STATISTICS``, built-in expressions
over the whole text. A random forest of shallow trees is grown on labelled
documents; every path from a root to a node becomes a rule, a conjunction of
bounds on figures, in which bounds on one figure are merged. Equal rules count
once. Logistic regression with an L1 penalty gives most rules no weight; the rest
is compiled into one SQL expression over the figures, so scoring is a narrow pass
without Python.

Trees and weights are fitted by Spark over all labelled rows, equal ones merged
into one with their number as weight.

Defined results: null and empty texts have figures of zero and are scored like
any other. Of several labels of a document the greatest counts; labels without id
or value don't. Repeated rows get equal scores; rows without an id are scored, but
never learned from. With no labelled row, or labels of one class, the score is
their share of ones (0.5 without any). An empty table gives no rows, and columns
with other names are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgelens.llm.common import stored

TREES, DEPTH, SEED = 24, 3, 17
PENALTY = 0.0003
ITERATIONS = 100

def _share(marks: str, of: str) -> str:
    """SQL: how many characters of a set the text has, per ``of``."""
    return f"(length(text) - length(regexp_replace(text, '[{marks}]+', ''))) / {of}"


# Figures of a text; ``words``, ``lines`` and the code points in words, ``size``, are given.
_PER_WORD, _PER_LINE, _PER_POINT = "greatest(size(words), 1)", "greatest(size(lines), 1)", "greatest(size, 1)"
STATISTICS = {
    "n_words": "double(size(words))",
    "word_length": f"size / {_PER_WORD}",
    "longest_word": "double(coalesce(array_max(transform(words, w -> length(w))), 0))",
    "repeated_next": f"size(filter(zip_with(words, slice(words, 2, {_PER_WORD}), (a, b) -> a = b), x -> x)) / {_PER_WORD}",
    "symbols": _share("#*$%&|<>", _PER_POINT),
    "digits": _share("0-9", _PER_POINT),
    "upper_case": _share(r"\\p{Lu}", _PER_POINT),
    "letters": f"length(regexp_replace(text, '[^\\\\p{{L}}]+', '')) / {_PER_POINT}",
    "exclamations": _share("!", _PER_WORD),
    "endings": _share(".!?।؟。", _PER_WORD),
    "commas": _share(",;:", _PER_WORD),
    "n_lines": "double(size(lines))",
    "line_words": f"size(words) / {_PER_LINE}",
    "repeated_lines": f"1 - size(array_distinct(lines)) / {_PER_LINE}",
}
_NAMES = list(STATISTICS)
_BLANK = "[\\\\x20\\\\x09-\\\\x0D]"


def statistics(docs: DataFrame, text: str = "text", **kept: Column) -> DataFrame:
    """``kept`` columns and the figures of every row's text."""
    body = docs.select(*(c.alias(n) for n, c in kept.items()), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    cut = body.withColumn("words", F.expr(f"array_remove(split(text, '{_BLANK}+'), '')"))
    cut = cut.withColumn("lines", F.expr(f"filter(split(text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')"))
    cut = cut.withColumn("size", F.expr(f"length(regexp_replace(text, '{_BLANK}+', ''))"))
    return cut.select(*kept, *(F.expr(sql).alias(name) for name, sql in STATISTICS.items()))


class Rule(NamedTuple):
    """Figures that lie above ``low`` and at or below ``high``: (name, low, high)."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def sql(self) -> str:
        parts = []
        for name, low, high in self.bounds:
            parts += [f"{name} > {low!r}D"] if low is not None else []
            parts += [f"{name} <= {high!r}D"] if high is not None else []
        return "(" + " AND ".join(parts) + ")"


class Ensemble(NamedTuple):
    """Rules with weights; the logistic function of their sum is the score."""

    base: float
    rules: list[tuple[Rule, float]]

    def sql(self) -> str:
        terms = [f"CASE WHEN {rule.sql()} THEN {weight!r}D ELSE 0D END" for rule, weight in self.rules]
        return f"1D / (1D + exp(-({' + '.join([f'{self.base!r}D', *terms])})))"


_TEST = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")


def paths(described: str, names: list[str]) -> Iterator[Rule]:
    """The rules of a tree from its printed form: one per node below the root."""
    stack: list[tuple[int, str, str, float]] = []
    for line in described.split("\n"):
        test = _TEST.match(line)
        if not test:
            continue
        depth = len(test[1])
        stack = [s for s in stack if s[0] < depth] + [(depth, names[int(test[3])], test[4], float(test[5]))]
        bounds: dict[str, list] = {}
        for _, name, sign, value in stack:
            low, high = bounds.setdefault(name, [None, None])
            if sign == ">":
                bounds[name][0] = value if low is None else max(low, value)
            else:
                bounds[name][1] = value if high is None else min(high, value)
        yield Rule(tuple((n, *b) for n, b in sorted(bounds.items())))


def fit(rows: DataFrame) -> Ensemble:
    """An ensemble from figures, ``label`` (0 or 1) and ``weight`` of labelled rows."""
    sums = rows.agg(F.sum("weight"), F.sum(F.col("label") * F.col("weight"))).first()
    whole, ones = sums[0] or 0.0, sums[1] or 0.0
    if ones in (0.0, whole):
        share = ones / whole if whole else 0.5
        return Ensemble({0.0: -20.0, 1.0: 20.0}.get(share, 0.0), [])
    vector = array_to_vector(F.array(*_NAMES)).alias("features")
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="onethird", seed=SEED, weightCol="weight")
    grown = forest.fit(rows.select(vector, "label", "weight"))
    rules = sorted({rule for tree in grown.trees for rule in paths(tree.toDebugString, _NAMES)}, key=Rule.sql)
    if not rules:
        return Ensemble(0.0, [])
    # Rows that meet the same rules count as one: the fit sees patterns, not documents.
    met = F.array(*(F.expr(f"double{rule.sql()}") for rule in rules)).alias("met")
    patterns = stored(rows.select(met, "label", "weight").groupBy("met", "label").agg(F.sum("weight").alias("weight")), "patterns")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=ITERATIONS, standardization=False, weightCol="weight")
    fitted = lasso.fit(patterns.select(array_to_vector("met").alias("features"), "label", "weight"))
    weights = fitted.coefficients.toArray().tolist()
    return Ensemble(float(fitted.intercept), [(r, w) for r, w in zip(rules, weights) if w])


def labelled(figures: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """Figures of documents with a label, equal rows merged, with their number."""
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max(label).cast("double").alias("label"))
    merged = figures.groupBy("doc_id", *_NAMES).agg(F.count("*").cast("double").alias("weight"))
    return merged.join(marks, "doc_id").drop("doc_id")


def classify(docs: DataFrame, labels: DataFrame, train: Column, label: str = "quality", least: float = 0.3) -> DataFrame:
    """doc_id, train, score and predicted (1 from ``least`` on) of every row of
    ``docs``, learned from those where ``train`` is true."""
    figures = stored(statistics(docs, doc_id=F.col("doc_id"), train=train), "figures")
    model = fit(stored(labelled(figures.filter("train"), labels, label), "labelled"))
    scored = figures.select("doc_id", "train", F.expr(model.sql()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= least).cast("int"))
