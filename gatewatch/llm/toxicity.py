"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton.

Folding: lower case, homoglyphs and accents to plain letters, invisible
characters away, digits and signs that stand for letters to those letters,
everything else to single spaces. The lexicon holds whole words and word
beginnings (so inflected forms of a stem count); their weights are log-odds
between toxic and clean labelled rows. Each word counts once, with its heaviest
entry; words inside an exception phrase do not count. The sum of weights and
the sum per hundred words (the length-normalised form) enter a logistic curve
fitted on the same rows.

Only the text is an input of a score. Labels are read from rows whose
crc32(id as text) mod 5 is not 0. The model is fitted on at most about
``max_rows`` of them (a documented bound; picked by a hash of the id), the
scores cover every row and whole texts.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table, text_or_empty, whole_row, with_id

# Letters that look like a Latin letter, and signs that stand for one.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "і": "i", "ї": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "ı": "i", "ℓ": "l",
    "α": "a", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
SIGNS = {"@": "a", "$": "s", "!": "i"}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "idiot proof", "scum line")
INVISIBLE = "­​‌‍⁠﻿"
FLOOR = 0.1
STEMS = (3, 4, 5, 6, 7, 8)


def fold_table() -> dict[int, str | None]:
    """Code point to folded text, by rule for accents and wide forms."""
    out: dict[int, str | None] = {}
    for c in [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x300, 0x370), *range(0xFF01, 0xFF5F)]:
        plain = unicodedata.normalize("NFKD", chr(c)).lower()
        plain = "".join(x for x in plain if not unicodedata.combining(x))
        out[c] = "".join(LEET.get(x, x) if x.isalnum() else " " for x in plain) if plain else None
    for c in range(0x80):
        out[c] = LEET.get(chr(c), chr(c)) if chr(c).isalnum() else " "
    out |= {ord(a): b for a, b in HOMOGLYPHS.items()}
    out |= {ord(a): None for a in INVISIBLE}
    for block in (range(0x2000, 0x2070), range(0x3000, 0x3004)):
        out |= {c: " " for c in block if chr(c) not in INVISIBLE}
    return out


def folder():
    """A function from text to its folded words between single spaces."""
    plain = fold_table()
    sign = re.compile(r"(?<=[^\W_])[@$!](?=[^\W_])|(?<=[^\W_])[@$!](?=[@$!][^\W_])")

    def fold(text: str) -> str:
        if "@" in text or "$" in text or "!" in text:
            text = sign.sub(lambda m: SIGNS[m.group()], text)
        return f" {' '.join(text.lower().translate(plain).split())} "

    return fold


def entries(word: str) -> list[str]:
    """The lexicon entries that a folded word can match: itself and its stems."""
    return [f" {word} ", *(f" {word[:k]}" for k in STEMS if len(word) > k)]


@dataclass
class Model:
    """Lexicon weights, exception phrases and the logistic curve."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    curve: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def score(self, total: float, n_words: int) -> float:
        bias, a, b = self.curve
        z = bias + a * math.log1p(total) + b * math.log(FLOOR + 100.0 * total / max(n_words, 1))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def matcher(model: Model):
    """A function from folded text to {start of word: weight} without exceptions."""
    machine = ahocorasick.Automaton()
    for entry, weight in model.weights.items():
        machine.add_word(entry, (len(entry), weight))
    for phrase in model.exceptions:
        machine.add_word(f" {phrase} ", (len(phrase) + 2, None))
    if len(machine):
        machine.make_automaton()

    def match(text: str) -> dict[int, float]:
        found: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (length, weight) in machine.iter(text) if len(machine) else ():
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        if not spared or not found:
            return found
        # both in order of the text: one pass over the starts and the phrases' union
        spared.sort()
        kept, at, reach = {}, 0, -1
        for start in sorted(found):
            while at < len(spared) and spared[at][0] <= start:
                reach = max(reach, spared[at][1])
                at += 1
            if start >= reach:
                kept[start] = found[start]
        return kept

    return match


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, max_rows: int) -> DataFrame:
    """(text, toxic) of the training rows. Rows with a null id or label are left
    out; of several labels for an id the largest counts."""
    own = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic")).dropna()
    own = own.where(F.crc32(F.col("id").cast("string")) % 5 != 0).groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = max_rows / max(own.count(), 1)
    if share < 1:
        own = own.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    # at most about max_rows rows of two numbers
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(F.broadcast(own), "id")


def learn_weights(rows: DataFrame, min_toxic: int = 3, size: int = 5000) -> dict[str, float]:
    """Entries and their weights (log-odds), from the number of toxic and clean
    rows that hold each. An entry needs a likelihood ratio beyond what chance
    gives among so many candidates. Of entries on nearly the same toxic rows the
    most specific stays; a longer entry goes if a beginning of it is as pure and more
    frequent."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = folder()
        seen: list[Counter] = [Counter(), Counter()]

        def flush() -> pa.RecordBatch:
            names = list(seen[0].keys() | seen[1].keys())
            out = pa.RecordBatch.from_arrays([
                pa.array(names, pa.string()), pa.array([seen[0][x] for x in names], pa.int64()),
                pa.array([seen[1][x] for x in names], pa.int64())], names=["entry", "clean", "toxic"])
            seen[0].clear(), seen[1].clear()
            return out

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[min(toxic, 1)].update({e for w in set(fold(text).split()) for e in entries(w)})
                if len(seen[0]) + len(seen[1]) > 300_000:
                    yield flush()
        yield flush()

    counted = rows.select("text", "toxic").mapInArrow(work, "entry string, clean long, toxic long")
    counted = counted.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return {}
    t, c, share = F.col("toxic"), F.col("clean"), toxic / (toxic + clean)
    odds = F.log((t + 0.5) / (toxic - t + 0.5)) - F.log((c + 0.5) / (clean - c + 0.5))
    ratio = 2 * (t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0))
    able = checkpointed(counted.where((t >= min_toxic) & (c * toxic < t * clean))
                        .select("entry", "toxic", "clean", odds.alias("weight"), ratio.alias("ratio")))
    chance = 2 * math.log(max(able.count(), 1))
    top = able.where(F.col("ratio") > chance).orderBy(F.desc("ratio"), "entry").limit(size).collect()
    found = {r.entry: r for r in top}
    shorter = lambda e: [found[e[:k]] for k in range(2, len(e)) if e[:k] in found]
    plain = {s.entry for e, r in found.items() for s in shorter(e) if 0.9 * s.toxic <= r.toxic and s.clean >= r.clean}
    return {e: r.weight for e, r in found.items() if e not in plain and not any(
        s.clean * r.toxic <= r.clean * s.toxic and s.toxic >= 1.05 * r.toxic for s in shorter(e) if s.entry not in plain)}


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = 20_000,
        exceptions: tuple[str, ...] = EXCEPTIONS, max_phrases: int = 5000) -> Model:
    """The model of at most about ``max_rows`` labelled rows. Without rows of
    both labels it has no lexicon, and its score is near 0 (or near 1 if all
    rows are toxic) for every text."""
    rows = labelled(docs, labels, id_col, text_col, max_rows)
    model = Model(learn_weights(rows), ())
    if not model.weights:
        learned: set[str] = set()
    else:
        by_label = phrases_beside_hits(rows, model).where("clean >= 8 and clean >= 8 * (toxic + 1)")
        learned = {r.phrase for r in by_label.orderBy(F.desc("clean"), "phrase").limit(max_phrases).collect()}
    model.exceptions = tuple(sorted(learned | set(exceptions)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, match = folder(), matcher(model)
        for batch in batches:
            plain = [fold(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([p.count(" ") - 1 for p in plain], pa.int64()), pa.array([sum(match(p).values()) for p in plain], pa.float64())],
                names=["toxic", "n_words", "total"])

    seen = rows.select("text", "toxic").mapInArrow(work, "toxic int, n_words long, total double").collect()  # three numbers a row
    if not seen:
        return model
    total = np.array([r.total for r in seen])
    words = np.array([max(r.n_words, 1) for r in seen], float)
    label = np.array([min(r.toxic, 1) for r in seen], float)
    model.curve = logistic(np.stack([np.ones(len(seen)), np.log1p(total), np.log(FLOOR + 100 * total / words)], 1), label)
    return model


def phrases_beside_hits(rows: DataFrame, model: Model) -> DataFrame:
    """(phrase, clean, toxic): how many rows of either label hold a hit with the
    word before or after it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, match = folder(), matcher(model)
        counts: list[Counter] = [Counter(), Counter()]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                plain, held = fold(text), set()
                for start in match(plain):
                    end = plain.index(" ", start + 1)
                    if start:
                        held.add(plain[plain.rfind(" ", 0, start) + 1 : end])
                    if end + 1 < len(plain):
                        held.add(plain[start + 1 : plain.find(" ", end + 1)])
                counts[min(toxic, 1)].update(held)
        names = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array([counts[0][p] for p in names], pa.int64()), pa.array([counts[1][p] for p in names], pa.int64())],
            names=["phrase", "clean", "toxic"])

    return rows.select("text", "toxic").mapInArrow(work, "phrase string, clean long, toxic long").groupBy("phrase").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05) -> tuple[float, ...]:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score): one row per row of ``docs``. A null text counts as empty; an
    empty text has the score of a text without matches. Repeated rows are kept;
    other columns are not read; a null id keeps its row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, match = folder(), matcher(model)
        for batch in batches:
            scores = []
            for value in batch.column(1):
                plain = fold(value.as_py())
                scores.append(model.score(sum(match(plain).values()), plain.count(" ") - 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["id", "score"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(
        work, with_id(docs, id_col, "score double"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs``, all columns, without the rows scored 0.5 or more. The decision
    travels beside the row, so rows with a null id are judged too."""
    model = fit(docs, labels, id_col, text_col, **how)
    packed = docs.select(whole_row(docs).alias("row"), F.col(text_col).alias("text"))
    return toxicity(packed, model, "row", "text").where("score < 0.5").select("id.*")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every row of ``documents``, learnt from ``labels``. A row with a
    null id is neither learnt from nor held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        F.col("id").alias("doc_id"), F.coalesce(F.crc32(F.col("id").cast("string")) % 5 == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
