"""Periodic runs of words, by Lyndon roots from a grouping of suffixes.

A run is a stretch of words with smallest period q that no neighbour extends and
that is at least ``min_exponent`` periods and ``min_length`` words long. Every run
holds, in one of the two orders of the words (ascending or descending), a Lyndon
root of q words at each of whose places in the run, the first word of the run
apart, the longest Lyndon word is this root.

The Lyndon array of either order is what the first phase of the grouping
construction of suffix arrays leaves behind: suffixes are grouped by Lyndon
prefix, groups are taken from the greatest down, and when a group is taken its
prefix is the longest Lyndon word at each of its places. The second phase is not
needed. Each root is extended to both sides by longest common extensions, exactly,
over names of the strings of 1, 2, 4, ... words; equal results are one run.

A text is first cut at pairs of neighbouring words that stand in it fewer than
``min_exponent - 1`` times: no run reaches over such a pair, since a run of that
many periods repeats each of its pairs at least that often. The cut is by hashes,
which can only join too much; what is left goes to the grouping as exact words.
Texts are independent rows, so nothing is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, byte_chunks, mix, spaced, span_hashes, spans, table, text_or_empty, utf8_rows, with_id

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
CHUNK = 4 << 20


def lyndon_array(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word at each place of a sequence of integers.

    Groups hold the places of equal Lyndon prefix and are linked by their order.
    The greatest group not yet taken is taken: its prefix is final. Each of its
    places hangs on the nearest place before it in a lower group. A place on which
    k of them hang is followed by k copies of the prefix, which its own prefix now
    swallows: it moves to a new group right above its old one (of several new ones
    a greater k is higher)."""
    n = len(symbols)
    values = sorted(set(symbols))
    order = {s: g for g, s in enumerate(values)}
    group = [order[s] for s in symbols]
    places: list[list[int]] = [[] for _ in values]
    for i, g in enumerate(group):
        places[g].append(i)
    prefix = [1] * len(values)
    lower = list(range(-1, len(values) - 1))
    higher = [*range(1, len(values)), -1]
    out = [0] * n
    free = list(range(n))  # a place that is not taken, else some place before it
    g = len(values) - 1
    while g >= 0:
        size = prefix[g]
        own = [i for i in places[g] if group[i] == g]
        for i in own:
            out[i] = size
            free[i] = i - 1
        hangs: dict[int, int] = {}
        for i in own:
            at = i - 1
            while at >= 0 and (to := free[at]) != at:
                if to >= 0:
                    free[at] = to = free[to]
                at = to
            if at >= 0:
                hangs[at] = hangs.get(at, 0) + 1
        new: dict[tuple[int, int], int] = {}
        for at, k in sorted(hangs.items(), key=lambda h: -h[1]):
            old = group[at]
            to = new.get((old, k), -1)
            if to < 0:  # right above the old group; the next one, of fewer copies, goes below this one
                to = new[old, k] = len(places)
                places.append([])
                prefix.append(prefix[old] + k * size)
                up = higher[old]
                lower.append(old)
                higher.append(up)
                higher[old] = to
                if up >= 0:
                    lower[up] = to
            group[at] = to
            places[to].append(at)
        g = lower[g]
    return out


class Extensions:
    """Longest common extensions in a sequence, over names of all strings of
    1, 2, 4, ... symbols; equal names are equal strings."""

    def __init__(self, symbols: np.ndarray, longest: int) -> None:
        self.names = [np.unique(symbols, return_inverse=True)[1].astype(np.int64)]
        while (half := 1 << (len(self.names) - 1)) * 2 <= longest and len(self.names[-1]) > half:
            last = self.names[-1]
            pairs = last[:-half] * (int(last.max()) + 1) + last[half:]
            self.names.append(np.unique(pairs, return_inverse=True)[1])

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that agree from i and j on, where i < j."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name = self.names[k]
            able = np.flatnonzero(j + out < len(name))
            a = out[able]
            out[able] = a + ((name[i[able] + a] == name[j[able] + a]).astype(np.int64) << k)
        return out

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Symbols that agree before i and j, where i < j."""
        out = np.zeros(len(i), np.int64)
        for k in range(len(self.names) - 1, -1, -1):
            name, width = self.names[k], 1 << k
            able = np.flatnonzero(i - out >= width)
            a = out[able] + width
            out[able] = a - width + ((name[i[able] - a] == name[j[able] - a]).astype(np.int64) << k)
        return out


def runs_of(sequences: list[list[int]], min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, ...]:
    """(sequence, start, length, period) of the runs of some integer sequences,
    in order of sequence, start and period. Exponents below 2 are no runs."""
    size = np.array([len(s) for s in sequences], np.int64)
    begin = np.concatenate(([0], np.cumsum(size + 1)))  # one place after each sequence belongs to none
    joined = np.zeros(begin[-1], np.int64)
    place, period = [], []
    for k, s in enumerate(sequences):
        joined[begin[k] : begin[k] + len(s)] = s
        joined[begin[k] + len(s)] = -1 - k
        for order in (s, [-x for x in s]):
            roots = np.array(lyndon_array(order), np.int64)
            at = np.flatnonzero(np.arange(len(s)) + roots < len(s))
            place.append(begin[k] + at)
            period.append(roots[at])
    i, p = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (place, period))
    same = joined[i] == joined[i + p]
    i, p = i[same], p[same]
    if not len(i):
        return (np.zeros(0, np.int64),) * 4
    reach = Extensions(joined, int(size.max()))
    right = reach.forward(i, i + p)
    far = right > (min_exponent - 2) * p  # so far from the first whole root of a run
    i, p, right = i[far], p[far], right[far]
    left = reach.backward(i, i + p)
    length = left + p + right
    run = length >= np.maximum(min_length, min_exponent * p)
    found = np.unique(np.stack([(i - left)[run], p[run], length[run]], 1), axis=0)
    which = np.searchsorted(begin, found[:, 0], side="right") - 1
    return which, found[:, 0] - begin[which], found[:, 2], found[:, 1]


def stretches(words: np.ndarray, row: np.ndarray, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of the pieces of rows that can hold runs; ``words`` are
    hashes, ``row`` their rows. Cut three times, each time by the counts of pairs
    within the pieces left."""
    first, end = np.flatnonzero(np.diff(row, prepend=-1)), np.flatnonzero(np.diff(row, append=-1)) + 1
    for _ in range(3):
        piece = np.repeat(np.arange(len(first)), end - first)
        at = np.repeat(first - np.concatenate(([0], np.cumsum(end - first)[:-1])), end - first) + np.arange(len(piece))
        pair = np.flatnonzero(piece[1:] == piece[:-1])
        a = at[pair]
        key = mix(mix(words[a] + piece[pair].astype(np.uint64) * np.uint64(BASE)) + words[a + 1])
        _, number, count = np.unique(key, return_inverse=True, return_counts=True)
        live = np.zeros(len(piece) + 1, bool)
        live[pair] = count[number] >= min_exponent - 1
        lo, hi = spans(live)
        long = hi - lo + 1 >= min_length
        lo, hi = lo[long], hi[long]
        before, first, end = len(piece), at[lo], at[hi - 1] + 2
        if not len(first) or int((end - first).sum()) == before:
            break
    return first, end


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                  min_exponent: int = 4) -> DataFrame:
    """(id, n_words, runs, collapsed): one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+``. runs are sorted by start and period (word
    numbers); collapsed are the words without those that stand in a run after its
    first period, joined by one space. Null and empty texts have no words and no
    runs; repeated rows and null ids keep their rows; other columns are not read. A
    text is handled whole: names take about 8 bytes for each word of its pieces and
    each doubling up to its longest piece."""
    if min_exponent < 2:
        raise ValueError("a run has an exponent of 2 at least")

    def solve(raw: np.ndarray, at: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, list[list[dict]], list[str]]:
        data, row_at = spaced(raw, at, lo, hi, 0x20)
        start, stop = spans(~WHITE[data])
        row = np.searchsorted(row_at, start, side="right") - 1
        found: list[list[dict]] = [[] for _ in range(hi - lo)]
        text = data.tobytes()
        word = lambda a, b: [text[x:y] for x, y in zip(start[a:b].tolist(), stop[a:b].tolist(), strict=True)]  # noqa: E731
        first, end = stretches(span_hashes(data, start, stop), row, min_length, min_exponent)
        number: dict[bytes, int] = {}
        pieces = [[number.setdefault(w, len(number)) for w in word(a, b)] for a, b in zip(first.tolist(), end.tolist(), strict=True)]
        begin = np.searchsorted(row, np.arange(hi - lo + 1))
        for k, s, n, p in zip(*(x.tolist() for x in runs_of(pieces, min_length, min_exponent)), strict=True):
            r = int(row[first[k]])
            found[r].append({"start": int(first[k] - begin[r]) + s, "length": n, "period": p})
        kept = []
        for r, own in enumerate(found):
            if own:
                gone = np.zeros(begin[r + 1] - begin[r] + 1, np.int64)
                np.add.at(gone, [x["start"] + x["period"] for x in own], 1)
                np.add.at(gone, [x["start"] + x["length"] for x in own], -1)
                live = (np.cumsum(gone[:-1]) == 0).tolist()
                words = [w for w, keep in zip(word(begin[r], begin[r + 1]), live, strict=True) if keep]
            else:
                words = text[row_at[r] : row_at[r + 1]].split()
            kept.append(b" ".join(words).decode())
        return np.diff(begin), found, kept

    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column(1))
            for lo, hi in byte_chunks(at, CHUNK):
                n, found, kept = solve(raw, at, lo, hi)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n, pa.int64()), pa.array(found, kind), pa.array(kept, pa.string())],
                    names=["id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(
        work, with_id(docs, id_col, f"n_words long, runs {RUNS}, collapsed string"))


def planted_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the query: with h the CRC-32 of the id and g = h // 10,
    where h % 10 is 0 the words from a = g % n on repeat with the period
    1 + (n - a) // (3 + g % 8). A null id changes nothing."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for k, i in enumerate(batch.column(0).to_pylist()):
                h = 1 if i is None else zlib.crc32(str(i).encode())
                if h % 10 == 0 and (words := texts[k].encode().split()):
                    g, n = h // 10, len(words)
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    tail = words[a : a + p] * (-(-(n - a) // p))
                    texts[k] = b" ".join(words[:a] + tail[: n - a]).decode()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long"), text_or_empty("text")).mapInArrow(work, "doc_id long, text string")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every row of ``documents`` with its planted tail."""
    found = periodic_runs(planted_tails(table(spark, sf_dir, "documents")))
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as s, -r.period as p)))")
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))")
    return found.withColumn("best", best).select(
        F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


OP11_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-]+') AS w, xor(4294967295, list_reduce(
        list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) AS h
    FROM documents
), cut AS (
    SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a FROM texts
), words AS (
    SELECT doc_id, n, i, w[1 + CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM cut)
), steps AS (
    SELECT x.doc_id, y.i - x.i AS q, x.i FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i
        AND 4 * (y.i - x.i) <= x.n
), islands AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM steps)
    GROUP BY doc_id, q, island HAVING count(*) >= 3 * q AND count(*) + q >= 6
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM islands GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS digest
    FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length DESC, start, period) = 1
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), kept AS (
    SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS digest FROM words ANTI JOIN dropped USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(b.start AS BIGINT) AS start, CAST(b.length AS BIGINT) AS length,
    CAST(b.period AS BIGINT) AS period, CAST(1000 * b.length // b.period AS BIGINT) AS exponent_milli,
    coalesce(l.digest, sha256('')) AS runs_sha256, coalesce(k.digest, sha256('')) AS collapsed_sha256
FROM texts LEFT JOIN listed l USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""
