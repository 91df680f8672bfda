"""License scan: an exact set-similarity join of text blocks with templates.

A text is cut into overlapping blocks of ``2 * stride`` words, one starting
every ``stride`` words, where ``stride`` is at least the number of words of the
longest template; so a template that stands in a text stands whole in a block. A
block matches a template when it holds at least the template's share
(``threshold``) of its distinct words.

All template words are ordered by the number of texts that hold them, rarest
first (counted over the whole table). If ``need`` words must be shared, the two
ordered sets share a word among the first ``size - need + 1`` of each (prefix
filter); blocks with fewer than ``need`` template words fail (length filter);
and a first shared word at places i and j leaves at most
``1 + min(len(t) - i - 1, len(b) - j - 1)`` shared words (positional filter).
What is left is verified on the sets. A template may name words that must be
held (``required``), such as the one that turns a license into a non-commercial
one; in a block, a template gives way to those of its family whose required words
include its own and more. A template marked ``exact`` also reports the places where
its words stand consecutively; a place belongs to the block in whose first
``stride`` words it begins, so it counts once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import alnum_words, table, text_or_empty, with_id


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.8
    exact: bool = False
    family: str = ""
    required: str = ""

    def outdone_by(self, other: Template) -> bool:
        own, its = set(self.required.split()), set(other.required.split())
        return self.family != "" and self.family == other.family and own < its

    @property
    def words(self) -> list[str]:
        return [w.decode() for w in alnum_words(self.text.encode())]


# The base phrases, and opening sentences of common licenses.
BASE = (
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
)
CC_PARTS = (
    ((), ()), (("nc",), ("NonCommercial",)), (("sa",), ("ShareAlike",)), (("nd",), ("NoDerivatives",)),
    (("nc", "sa"), ("NonCommercial", "ShareAlike")), (("nc", "nd"), ("NonCommercial", "NoDerivatives")),
)
NOTICES = (
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
             "documentation files, to deal in the Software without restriction"),
    Template("apache", "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the License"),
    Template("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
             "Public License as published by the Free Software Foundation", family="gnu"),
    Template("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
             "Public License as published by the Free Software Foundation", family="gnu", required="lesser"),
    Template("agpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
             "Public License as published by the Free Software Foundation", family="gnu", required="affero"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met"),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies"),
    Template("unlicense", "This is free and unencumbered software released into the public domain"),
    Template("cc0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related "
             "or neighboring rights to this work"),
    *(Template("-".join(["cc-by", *parts]), f"licensed under a Creative Commons Attribution {' '.join(names)} 4.0 International License",
               family="cc", required=" ".join(n.lower() for n in names)) for parts, names in CC_PARTS),
    *(Template("-".join(["cc-by", *parts]), f"licensed under CC BY {' '.join(parts)} 4.0", 1.0, family="cc", required=" ".join(parts))
      for parts, _ in CC_PARTS),
    Template("proprietary", "all rights reserved no part of this publication may be reproduced without the prior written permission"),
)
MATCH = "struct<template:int,label:string,start:bigint,end:bigint,containment:double,places:array<bigint>>"


def word_order(docs: DataFrame, text_col: str, vocabulary: set[str]) -> dict[str, int]:
    """Rank of each template word by the number of rows that hold it."""
    own = {w.encode() for w in vocabulary}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                seen.update(own.intersection(alnum_words(value.as_py())))
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode() for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

    rows = docs.select(text_or_empty(text_col)).mapInArrow(work, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    count = {r.word: r.n for r in rows.collect()}  # as many rows as template words at most
    return {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (count.get(w, 0), w)))}


def license_blocks(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES, id_col: str = "doc_id",
                   text_col: str = "text", min_stride: int = 32, max_template_words: int = 100_000) -> DataFrame:
    """(id, n_words, matches): one row per row of ``docs``.

    matches lists every matching (template, block): the template's number and
    label, the block's words [start, end), the containment, and the places of an
    exact template. Templates without words match nothing. Null and empty texts
    have no words and no blocks; repeated rows are kept; a null id keeps its
    row; other columns are not read. The templates are the query set and go to
    every task, so their size is checked."""
    if sum(len(t.words) for t in templates) > max_template_words:
        raise ValueError(f"the templates have over {max_template_words} words; scan in parts or raise max_template_words")
    stride = max([min_stride, *(len(t.words) for t in templates)])
    rank = word_order(docs, text_col, {w for t in templates for w in [*t.words, *t.required.split()]})
    plans, index = [], {}
    for number, t in enumerate(templates):
        ordered = sorted({rank[w] for w in t.words})
        need = max(1, math.ceil(t.threshold * len(ordered) - 1e-9))
        plans.append((t.label, frozenset(ordered), ordered, need, [w.encode() for w in t.words] if t.exact else None,
                      frozenset(rank[w] for w in t.required.split()), {k for k, other in enumerate(templates) if t.outdone_by(other)}))
        for i, w in enumerate(ordered[: len(ordered) - need + 1]):
            index.setdefault(w, []).append((number, i))
    code = {w.encode(): r for w, r in rank.items()}

    def scan(words: list[bytes]) -> list[dict]:
        known = [(i, code[w]) for i, w in enumerate(words) if w in code]
        out = []
        at = 0
        for start in range(0, len(words), stride):
            while at < len(known) and known[at][0] < start:
                at += 1
            held, to = set(), at
            while to < len(known) and known[to][0] < start + 2 * stride:
                held.add(known[to][1])
                to += 1
            block = sorted(held)
            tried: set[int] = set()
            found: list[dict] = []
            for j, w in enumerate(block):
                for number, i in index.get(w, ()):
                    if number in tried:
                        continue
                    tried.add(number)  # the first shared word decides
                    label, wanted, ordered, need, exact, required, _ = plans[number]
                    if len(block) < need or 1 + min(len(ordered) - i - 1, len(block) - j - 1) < need or j > len(block) - need:
                        continue
                    shared = len(wanted & held)
                    if shared < need or not required <= held:
                        continue
                    places = [p for p in range(start, min(start + stride, len(words) - len(exact) + 1))
                              if words[p] == exact[0] and words[p : p + len(exact)] == exact] if exact else []
                    found.append({"template": number, "label": label, "start": start, "end": min(start + 2 * stride, len(words)),
                                  "containment": shared / len(ordered), "places": places})
            numbers = {m["template"] for m in found}
            out += [m for m in found if numbers.isdisjoint(plans[m["template"]][6])]
        return out

    kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("containment", pa.float64()), ("places", pa.list_(pa.int64()))]))
    rare = {w for w, r in code.items() if r in index}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, matches = [], []
            for value in batch.column(1).cast(pa.binary()):
                words = alnum_words(value.as_py())
                n_words.append(len(words))
                matches.append([] if rare.isdisjoint(words) else scan(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(matches, kind)], names=["id", "n_words", "matches"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(
        work, with_id(docs, id_col, f"n_words long, matches array<{MATCH}>"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places, labels and score of every row of ``documents``."""
    found = license_blocks(table(spark, sf_dir, "documents"))
    base = F.expr(f"flatten(transform(filter(matches, m -> m.template < {len(BASE)}), m -> m.places))")
    sure = f"filter(matches, m -> m.template >= {len(BASE)} or size(m.places) > 0)"
    joined = lambda e: F.array_join(F.sort_array(F.array_distinct(F.expr(e))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(base).alias("first_word"), F.array_max(base).alias("last_word"),
        joined(f"transform(filter(matches, m -> m.template < {len(BASE)} and size(m.places) > 0), m -> m.label)").alias("base_labels"),
        joined(f"transform({sure}, m -> m.label)").alias("labels"),
        F.coalesce(F.expr(f"array_max(transform({sure}, m -> m.containment))"), F.lit(0.0)).alias("score"))


def op2_sql() -> str:
    """The query in DuckDB, by plain set arithmetic over every block."""
    stride = max([32, *(len(t.words) for t in BASE + NOTICES)])
    rows = ", ".join(
        f"({i}, '{t.label}', [{', '.join(repr(w) for w in sorted(set(t.words)))}], "
        f"{max(1, math.ceil(t.threshold * len(set(t.words)) - 1e-9))}, '{' '.join(t.words) if t.exact else ''}', {len(t.words)}, "
        f"{t.required.split()!r}::VARCHAR[], {[k for k, other in enumerate(BASE + NOTICES) if t.outdone_by(other)]}::INTEGER[])"
        for i, t in enumerate(BASE + NOTICES))
    return rf"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), templates(number, label, held, need, phrase, n, required, outdone) AS (VALUES {rows}
), places AS (
    SELECT d.doc_id, t.label, d.i FROM (SELECT doc_id, w, unnest(range(0, len(w))) AS i FROM words) d, templates t
    WHERE t.phrase <> '' AND array_to_string(d.w[i + 1 : i + t.n], ' ') = t.phrase
), blocks AS (
    SELECT doc_id, s, list_distinct(w[s + 1 : s + {2 * stride}]) AS b
    FROM (SELECT doc_id, w, unnest(range(0, len(w), {stride})) AS s FROM words)
), alike AS (
    SELECT doc_id, s, number, label, outdone, len(list_intersect(b, held)) / len(held) AS score
    FROM blocks, templates WHERE phrase = '' AND len(list_intersect(b, held)) >= need AND list_has_all(b, required)
), fuzzy AS (
    SELECT doc_id, label, score FROM (SELECT *, list(number) OVER (PARTITION BY doc_id, s) AS numbers FROM alike)
    WHERE NOT list_has_any(numbers, outdone)
), base AS (
    SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY doc_id
), every AS (
    SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
    FROM (SELECT doc_id, label, score FROM fuzzy UNION ALL SELECT doc_id, label, 1.0 FROM places) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM words w LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)
"""
