"""License scan: an exact set-similarity join of text blocks with license templates.

A block of a template is any run of consecutive words of a text, across line ends
and marks between words, as long as the template is with its share of other words
mixed in: ``words / threshold``. A template is found if one of its blocks holds at
least ``threshold`` of its distinct words (or the share it names), so it doesn't
matter how a notice was wrapped. The words of all templates are ordered by the
number of documents that hold them, the rarest first, counted over the whole
table. Three filters leave few pairs to verify, and lose none:
  prefix      a text, and a block, holds one of the template's first ``|T| - o + 1``
              words, where ``o`` is the overlap that the threshold asks for; only
              blocks around such a word are looked at;
  length      a text holds at least ``o`` words of the template;
  positional  at the common word, the words left on both sides still reach ``o``.
Words of no template can't add to an overlap; blocks that begin with one needn't
be looked at. Templates are fixed values, so their prefix index is a constant of
the query plan.

Labels also come from fixed phrases, counted wherever their words stand in a row
in the text. The score is 1 if a phrase was found, else the largest share of a
found template that one of its blocks holds, 0 if none was found.

Only DataFrame and SQL functions are used, and one narrow pass per scan: nothing
is joined or grouped by text. Null and empty texts have no words, no labels and
a score of 0. Repeated rows are scanned one by one, null ids stay null, texts of
any length are scanned whole, and of equal blocks the last counts. An empty
table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that give a label.
PHRASES = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}

THRESHOLD = 0.8

# Notices by which public licenses are recognised, and the share of
# their words that a block must hold, where a single word makes the difference.
TEMPLATES: list[tuple] = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("mit", "Released under the MIT License."),
    ("mit", "This project is licensed under the terms of the MIT license."),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the Software), to deal in the Software without restriction, including without"
        " limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of"
        " the Software",
    ),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation",
    ),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License.", 0.9),
    ("agpl", "This program is licensed under the GNU Affero General Public License.", 0.9),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
        " the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is"
        " hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

BREAKS = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def template_words(text: str) -> list[str]:
    return sorted(set(re.findall(r"[0-9a-z]+", text.lower())))


def block_words(text: str, share: float) -> int:
    """How long a block of a template is: all its words, with others mixed in."""
    return math.ceil(len(re.findall(r"[0-9a-z]+", text.lower())) / share - 1e-9)


def _texts(values: list[str]) -> str:
    return "array(" + ",".join(f"'{v}'" for v in values) + ")"


def spelled(text: str) -> str:
    """SQL: the words of a text, A-Z in lower case, with single spaces around each.

    The two letters whose lower case is an ASCII letter are kept apart from those;
    how other letters are spelled makes no difference to words of a-z and digits.
    """
    kept = f"replace(replace({text}, '\\u212a', '\\ue000'), '\\u0130', '\\ue000')"
    return f"concat(' ', trim(regexp_replace(lower({kept}), '{BREAKS}', ' ')), ' ')"


def _rows_in(words: str) -> str:
    """SQL: how many words a spelled text has."""
    return f"CASE WHEN {words} = '  ' THEN 0 ELSE length({words}) - length(replace({words}, ' ', '')) - 1 END"


def frequencies(docs: DataFrame, vocabulary: list[str], text: str = "text") -> dict[str, int]:
    """How many documents hold each word of the templates."""
    words = docs.select(F.expr(f"split({spelled(f'`{text}`')}, ' ')").alias("words"))
    held = words.select(F.explode(F.expr(f"array_intersect(words, {_texts(vocabulary)})")).alias("word"))
    counts = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return {w: counts.get(w, 0) for w in vocabulary}


class PrefixIndex:
    """Templates as sorted ranks of their words, and which prefixes hold a rank."""

    def __init__(self, templates: list[tuple], counts: dict[str, int], threshold: float):
        self.order = sorted(counts, key=lambda w: (counts[w], w))
        rank = {w: i + 1 for i, w in enumerate(self.order)}
        self.labels = [t[0] for t in templates]
        self.ranks = [sorted(rank[w] for w in template_words(text)) for _, text, *_ in templates]
        shares = [(*t, threshold)[2] for t in templates]
        self.overlaps = [max(1, math.ceil(s * len(t) - 1e-9)) for s, t in zip(shares, self.ranks)]
        self.least = min(self.overlaps)
        self.spans = [block_words(t[1], share) for t, share in zip(templates, shares)]
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for t, (ranks, overlap) in enumerate(zip(self.ranks, self.overlaps)):
            for i, r in enumerate(ranks[: len(ranks) - overlap + 1]):
                self.prefixes.setdefault(r, []).append((t, i))

    def prefix_words(self) -> list[str]:
        return [self.order[r - 1] for r in sorted(self.prefixes)]

    def found(self, ranks: str) -> str:
        """SQL: numbers of the templates whose overlap the sorted distinct ``ranks`` of a
        text reach."""
        probes = []
        for r in range(1, len(self.order) + 1):
            own = [
                f"struct({t} AS t, {len(self.ranks[t]) - i} AS after, {self.overlaps[t]} AS overlap)"
                for t, i in self.prefixes.get(r, [])
            ]
            probes.append(f"array({','.join(own)})" if own else "cast(array() AS array<struct<t:int,after:int,overlap:int>>)")
        index = f"array({','.join(probes)})"
        candidates = (
            f"array_distinct(flatten(transform({ranks}, (r, j) -> transform(filter(element_at({index}, r), c ->"
            f" size({ranks}) >= c.overlap AND least(c.after, size({ranks}) - j) >= c.overlap), c -> c.t))))"
        )
        return f"filter({candidates}, t -> size(array_intersect({ranks}, {self._of('t', self.ranks)})) >= {self._of('t', self.overlaps)})"

    @staticmethod
    def _of(t: str, values: list) -> str:
        """SQL: the value of template ``t``; lists become arrays."""
        each = [f"array({','.join(map(str, v))})" if isinstance(v, list) else str(v) for v in values]
        return f"element_at(array({','.join(each)}), {t} + 1)"

    def best(self, t: str, ranks: str) -> str:
        """SQL: (held, start) of the block of template ``t`` that holds most of its words,
        the last of equals, which has the least before it; ``ranks`` has 0 for other words.

        Blocks begin with a word of the template and hold one of its prefix words.
        """
        own, spans = self._of(t, self.ranks), self._of(t, self.spans)
        heads = self._of(t, [r[: len(r) - o + 1] for r, o in zip(self.ranks, self.overlaps)])
        rare = f"filter(sequence(1, size({ranks})), i -> array_contains({heads}, element_at({ranks}, i)))"
        starts = f"filter(sequence(greatest(1, p - {spans} + 1), p), s -> array_contains({own}, element_at({ranks}, s)))"
        held = f"struct(size(array_intersect(slice({ranks}, s, {spans}), {own})) AS held, s AS start)"
        return f"array_max(flatten(transform({rare}, p -> transform({starts}, s -> {held}))))"


def _places(phrase: str) -> tuple[Column, Column, Column]:
    """Places of a phrase in ``words``: their number, the first, the last."""
    parts = F.expr(f"split(words, '(?<= ){phrase}(?= )', -1)")
    spaces = lambda part: F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))
    n = F.size(parts) - 1
    first = spaces(F.element_at(parts, 1)) - 1
    last = F.col("n_words") - (spaces(F.element_at(parts, -1)) - 1) - len(phrase.split())
    return n, first, last


def scan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    phrases: dict[str, str] | None = None,
    templates: list[tuple] | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, and blocks: (first, label, share), the word at which the
    best block of every template that was found begins, from 0."""
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    vocabulary = sorted({w for _, t, *_ in templates for w in template_words(t)})
    index = PrefixIndex(templates, frequencies(docs, vocabulary, text), threshold)

    body = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body"))
    body = body.withColumn("words", F.expr(spelled("body"))).withColumn("n_words", F.expr(f"bigint({_rows_in('words')})"))

    zero, none = F.lit(0), F.lit(None).cast("int")
    each = []
    for label, phrase in phrases.items():
        n, first, last = _places(phrase)
        here = F.col("words").contains(f" {phrase} ")
        each.append(
            F.struct(
                F.lit(label).alias("label"),
                F.when(here, n).otherwise(zero).alias("n"),
                F.when(here, first).otherwise(none).alias("first"),
                F.when(here, last).otherwise(none).alias("last"),
            )
        )
    body = body.withColumn("places", F.filter(F.array(*each), lambda p: p["n"] > 0))

    # Only texts that hold a prefix word, and enough words of a template, are cut into blocks.
    held = f"array_intersect(split(words, ' '), {_texts(vocabulary)})"
    body = body.withColumn("held", F.expr(held))
    rank = f"int(array_position({_texts(index.order)}, w))"
    ready = f"size(held) >= {index.least} AND arrays_overlap(held, {_texts(index.prefix_words())})"
    body = body.withColumn("ranks", F.expr(f"CASE WHEN {ready} THEN array_sort(transform(held, w -> {rank})) END"))
    body = body.withColumn("near", F.expr(f"CASE WHEN ranks IS NOT NULL THEN {index.found('ranks')} END"))
    body = body.withColumn("ranked", F.expr(f"CASE WHEN size(near) > 0 THEN transform(split(trim(words), ' '), w -> {rank}) END"))
    best = f"transform(near, t -> struct(t, {index.best('t', 'ranked')} AS best))"
    body = body.withColumn("best", F.expr(f"CASE WHEN ranked IS NOT NULL THEN filter({best}, b -> b.best.held >= {index._of('b.t', index.overlaps)}) END"))
    sizes = index._of("b.t", [len(r) for r in index.ranks])
    label = f"element_at({_texts(index.labels)}, b.t + 1)"
    blocks = f"transform(best, b -> struct(b.best.start - 1 AS first, {label} AS label, b.best.held / {sizes} AS share))"
    body = body.withColumn("blocks", F.expr(blocks))
    empty = "cast(array() AS array<struct<first:int,label:string,share:double>>)"
    body = body.withColumn("blocks", F.coalesce("blocks", F.expr(empty)))
    base = F.transform("places", lambda p: p["label"])
    own = F.transform("blocks", lambda b: b["label"])
    shares = F.array_max(F.transform("blocks", lambda b: b["share"]))
    return body.select(
        "doc_id",
        "n_words",
        F.aggregate("places", F.lit(0).cast("long"), lambda s, p: s + p["n"]).alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["first"])).cast("long").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["last"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce(shares, F.lit(0.0))).alias("score"),
        "blocks",
    )
