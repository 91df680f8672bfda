"""Secret scan: fixed patterns, and tokens that a battery of tests calls random.

Tokens are maximal runs of ``[A-Za-z0-9+/_-]``; one with signs is tested whole and
in its parts between signs, if of ``min_length`` characters or more. The encoding
of a token is the smallest listed alphabet with all its characters. Against this
alphabet three tests are made of uniform randomness: chi-squared (by the number of
equal pairs of characters, to which it is linear), the runs above and below the
middle of the alphabet, and the serial correlation of neighbours. A token that
fails any of them at ``alpha`` (shared by the three) is not random.

The rest must also be unlike text. The null hypothesis is a token of the corpus'
own text: its characters (restricted to the encoding) and its changes between
digits, upper case, lower case and signs are counted over all tokens of all
documents. Under it the number of equal pairs is larger (moments of the
multinomial) and the number of class changes, also restricted to the encoding,
smaller (a Poisson tail bound). Twice the smaller p-value is the token's.

Discoveries are held to the false-discovery rate ``fdr`` by Benjamini and
Hochberg's rule over all distinct tokens of the corpus, with p-values weighted by
length: a long token has the power to show what it is, a short one has to be that
much more extreme. p-values are rounded up to steps of 5 %, so the rule needs only
the counts of (length band, step), not the tokens. Texts are read three times
(characters, p-values, spans); only counts and 16-byte prints of tokens move.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_chunks, spaced, spans, table, text_or_empty, utf8_rows, with_id

# The base patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

DIGITS, UPPER, LOWER, SIGNS = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "+/-_"
SYMBOLS = DIGITS + UPPER + LOWER + SIGNS
# Encodings, a smaller one first; numbers are no secrets, so the first is never random.
ENCODINGS = {
    "decimal": DIGITS, "hex": DIGITS + "abcdef", "HEX": DIGITS + "ABCDEF", "lower": LOWER, "upper": UPPER,
    "base32": UPPER + "234567", "base36": DIGITS + LOWER, "BASE36": DIGITS + UPPER, "letters": UPPER + LOWER,
    "base62": DIGITS + UPPER + LOWER, "base64": UPPER + LOWER + DIGITS + "+/", "base64url": UPPER + LOWER + DIGITS + "-_",
}
NAMES = list(ENCODINGS)
IN = np.array([[s in a for s in SYMBOLS] for a in ENCODINGS.values()])
VALUE = np.array([[a.find(s) for s in SYMBOLS] for a in ENCODINGS.values()])
SIZE = np.array([len(a) for a in ENCODINGS.values()])
NUMBER = np.full(256, 255, np.uint8)
NUMBER[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(len(SYMBOLS))
KIND = np.array([0] * 10 + [1] * 26 + [2] * 26 + [3] * 4)
HEX = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdef", np.uint8))
STEPS = 20  # steps of a p-value per factor e
SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
CHUNK = 4 << 20


@dataclass
class Text:
    """What tokens of text look like: character counts and class changes."""

    symbols: np.ndarray
    changes: np.ndarray  # [class, next class]

    def squares(self) -> np.ndarray:
        """Per encoding the sums of squared and of cubed shares of its characters."""
        share = np.where(IN, self.symbols + 1.0, 0.0)
        share /= share.sum(1, keepdims=True)
        return np.stack([(share**2).sum(1), (share**3).sum(1)])

    def turns(self) -> np.ndarray:
        """Per encoding and class the share of its characters after which another
        class follows, among those followed by a class of the encoding."""
        held = np.stack([IN[:, KIND == k].any(1) for k in range(4)], 1).astype(float)
        total, same = held @ self.changes.T, held * np.diag(self.changes)
        return (total - same + 1.0) / (total + 2.0)


def text_statistics(texts: DataFrame) -> Text:
    """Counts over the tokens of all rows; at most 82 numbers come to the driver."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, changes = np.zeros(256, np.int64), np.zeros(16, np.int64)
        for batch in batches:
            raw, at = utf8_rows(batch.column(0))
            for lo, hi in byte_chunks(at, CHUNK):
                number = NUMBER[spaced(raw, at, lo, hi)[0]]
                symbols += np.bincount(number, minlength=256)
                pair = np.flatnonzero((number[1:] < 255) & (number[:-1] < 255))
                changes += np.bincount(KIND[number[pair]] * 4 + KIND[number[pair + 1]], minlength=16)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(SYMBOLS) + 16)), pa.array(np.concatenate((symbols[: len(SYMBOLS)], changes)))],
                                         names=["k", "n"])

    out = np.zeros(len(SYMBOLS) + 16, np.int64)
    for r in texts.mapInArrow(work, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r.k] = r.n
    return Text(out[: len(SYMBOLS)], out[len(SYMBOLS) :].reshape(4, 4))


def tokens(data: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the tokens to be tested, wholes and parts, by start."""
    start, end = spans(NUMBER[data] < 255)
    part, part_end = spans(NUMBER[data] < 62)
    long, part_long = end - start >= min_length, part_end - part >= min_length
    both = np.unique(np.stack([np.concatenate((start[long], part[part_long])), np.concatenate((end[long], part_end[part_long]))], 1), axis=0)
    return both[:, 0], both[:, 1]


def tail(x: np.ndarray, mean: np.ndarray, above: bool) -> np.ndarray:
    """A bound of the chance of a Poisson number at least (or at most) x."""
    mean = np.maximum(mean, 1e-12)
    far = x > mean if above else x < mean
    return np.where(far, np.exp(np.minimum(0.0, x - mean - x * np.log(np.maximum(x, 1e-300) / mean))), 1.0)


def erfc(x: np.ndarray) -> np.ndarray:
    return np.vectorize(math.erfc, otypes=[float])(x)


def p_values(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: its encoding, the p-value of the battery against uniform
    randomness, and the p-value against text."""
    m, n = len(start), (end - start).astype(float)
    owner = np.repeat(np.arange(m), end - start)
    at = np.repeat(start - np.concatenate(([0], np.cumsum(end - start)[:-1])), end - start) + np.arange(len(owner)) if m else owner
    symbol = NUMBER[data[at]].astype(np.int64)
    counts = np.bincount(owner * len(SYMBOLS) + symbol, minlength=m * len(SYMBOLS)).reshape(m, len(SYMBOLS))
    fits = counts @ (~IN).T.astype(np.int64) == 0
    code = np.where(fits.any(1), fits.argmax(1), len(NAMES) - 1)
    size = SIZE[code].astype(float)
    pairs = (counts * (counts - 1)).sum(1) / 2.0
    # against uniform randomness
    expected = n * (n - 1) / 2 / size
    chi = np.minimum(1.0, 2 * np.minimum(tail(pairs, expected, True), tail(pairs, expected, False)))
    value = VALUE[code[owner], symbol].astype(float)
    sums = lambda w, k: np.bincount(k, w, minlength=m)
    next_ = np.flatnonzero(owner[1:] == owner[:-1]) if m else owner
    high = value >= size[owner] / 2
    ups = sums(high.astype(float), owner)
    downs = n - ups
    runs = 1 + sums((high[next_] != high[next_ + 1]).astype(float), owner[next_])
    both = 2 * ups * downs
    spread = both * (both - n) / (n * n * np.maximum(n - 1, 1))
    z = np.abs(runs - 1 - both / np.maximum(n, 1)) / np.sqrt(np.maximum(spread, 1e-9))
    run = np.where(spread > 0, erfc(z / math.sqrt(2)) if m else z, 0.0)
    off = value - (sums(value, owner) / np.maximum(n, 1))[owner]
    var = sums(off * off, owner)
    r = sums(off[next_] * off[next_ + 1], owner[next_]) / np.maximum(var, 1e-9)
    serial = np.where(var > 0, erfc(np.abs(r + 1 / n) * np.sqrt(n) / math.sqrt(2)) if m else r, 0.0)
    battery = np.minimum(1.0, 3 * np.minimum(np.minimum(chi, run), serial))
    # against text
    two, three = text.squares()[:, code]
    mean = n * (n - 1) / 2 * two
    deviation = np.sqrt(np.maximum(n * (n - 1) / 2 * (two + 2 * (n - 2) * three - (2 * n - 3) * two**2), 1e-9))
    even = erfc((mean - pairs) / deviation / math.sqrt(2)) / 2 if m else mean
    kinds = np.stack([counts[:, KIND == k].sum(1) for k in range(4)], 1)
    changed = sums((KIND[symbol[next_]] != KIND[symbol[next_ + 1]]).astype(float), owner[next_])
    mixed = tail(changed, (kinds * text.turns()[code]).sum(1), True)
    return code, battery, np.minimum(1.0, 2 * np.minimum(even, mixed))


def steps(p: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Length band (four to a doubling) and step of a p-value, which is at most exp(-step / STEPS)."""
    return (np.floor(4 * np.log2(length)).astype(np.int32) if len(length) else np.zeros(0, np.int32),
            np.floor(-np.log(np.maximum(p, 1e-300)) * STEPS).astype(np.int32))


def weight(band: np.ndarray, mean: float) -> np.ndarray:
    """Weight of a length band: its length over the mean one."""
    return np.exp2(np.asarray(band) / 4) / mean


def discoveries(cells: list[tuple[int, int, int]], fdr: float) -> tuple[float, float]:
    """(mean length, largest weighted p-value that passes) of Benjamini and
    Hochberg's rule over (band, step, number of tokens); -1 if none does."""
    if not cells:
        return 1.0, -1.0
    band, step, n = np.array(cells).T
    mean = float((np.exp2(band / 4) * n).sum() / n.sum())
    p = np.exp(-step / STEPS) / weight(band, mean)
    by = np.argsort(p, kind="stable")
    fine = np.flatnonzero(p[by] <= fdr * np.cumsum(n[by]) / n.sum())
    return mean, float(p[by][fine[-1]]) if len(fine) else -1.0


def base_spans(data: np.ndarray, text: bytes, row_at: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns in rows with a byte 0 after each."""
    out = [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    start, end = spans(HEX[data])
    long = end - start >= MIN_HEX
    out += zip(start[long].tolist(), [2] * int(long.sum()), end[long].tolist(), strict=True)
    assigned = np.flatnonzero((data == ord(":")) | (data == ord("=")))
    for r in np.unique(np.searchsorted(row_at, assigned, side="right") - 1).tolist():
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text, int(row_at[r]), int(row_at[r + 1]))
                if m.end(2) - m.start(2) >= MIN_ASSIGNED]
    return out


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 16, fdr: float = 0.01,
                 alpha: float = 1e-4) -> DataFrame:
    """(id, spans): one row per row of ``docs``; spans are sorted by start, then
    kind (assign, access, hex, random), in code points.

    Spans of one kind do not overlap: of random tokens the whole goes before its
    parts. Null and empty texts have no spans; repeated rows and null ids keep their
    rows, and equal tokens count once in the false-discovery rule; a table without
    tokens has no random ones; other columns are not read."""
    texts = docs.select(text_or_empty(text_col))
    text = text_statistics(texts)

    def tested(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        start, end = tokens(data, min_length)
        code, battery, p = p_values(data, start, end, text)
        p = np.where((code == 0) | (battery < alpha), 1.0, p)
        return (start, end, *steps(p, end - start))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column(0))
            for lo, hi in byte_chunks(at, CHUNK):
                data, _ = spaced(raw, at, lo, hi)
                start, end, band, step = tested(data)
                held = data.tobytes()
                prints = [hashlib.blake2b(held[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(prints, pa.binary()), pa.array(band), pa.array(step)], names=["print", "band", "step"])

    cells = (texts.mapInArrow(count, "print binary, band int, step int").distinct()
             .groupBy("band", "step").agg(F.count("*").alias("n")).collect())  # bounded by the bands and steps
    mean, bound = discoveries([tuple(r) for r in cells], fdr)

    def scan(data: np.ndarray, row_at: np.ndarray) -> list[list[dict]]:
        found = base_spans(data, data.tobytes(), row_at)
        start, end, band, step = tested(data)
        random = np.exp(-step / STEPS) / weight(band, mean) <= bound
        done = -1
        for a, b in sorted(zip(start[random].tolist(), (-end[random]).tolist(), strict=True)):
            if a >= done:
                done = -b
                found.append((a, 3, -b))
        lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        out: list[list[dict]] = [[] for _ in range(len(row_at) - 1)]
        for a, kind, b in sorted(found):
            r = int(np.searchsorted(row_at, a, side="right")) - 1
            begin = int(lead[row_at[r]])
            out[r].append({"kind": KINDS[kind], "start": int(lead[a]) - begin, "end": int(lead[b]) - begin})
        return out

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column(1))
            for lo, hi in byte_chunks(at, CHUNK):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(scan(*spaced(raw, at, lo, hi)), kind)], names=["id", "spans"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(work, with_id(docs, id_col, f"spans {SPANS}"))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every row of ``documents``."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.expr(f"filter(spans, s -> s.kind = '{kind}')")).cast("long").alias(f"n_{kind}")
    listed = lambda which: F.expr(f"array_join(transform(filter(spans, s -> {which}), s -> concat_ws(':', s.kind, s.start, s.end)), ',')")
    return found.select(
        F.col("id").alias("doc_id"), n("assign"), n("access"), n("hex"), F.sha2(listed("s.kind <> 'random'"), 256).alias("base_sha256"),
        listed("true").alias("spans"), n("random"))
