"""Benchmark decontamination by winnowing.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A
window is ``window`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window. For each window length the hashes of its
k-word grams are winnowed: of every ``window - k + 1`` consecutive grams the
smallest (leftmost on a tie) is kept, on both sides. Two equal windows keep the
same gram at the same place, so every shared window has a shared fingerprint.
Fingerprints of the documents are joined with those of the benchmark; each hit
is extended to the windows that contain the gram, and a window counts when it
equals a benchmark window (by two 64-bit hashes).

Windows and fingerprints of the benchmark are made in tasks; its text does not
reach the driver. Equal windows are one row with a set of items, so a passage that
many items share costs as one. What follows depends on the measured size of these
tables. Up to ``broadcast_bytes`` they go to the tasks and the documents are done
in one pass without a shuffle. Beyond it the documents are read once too: grams
that a bitmap of the benchmark's grams lets through (16 MB at any size) are joined
by key with the fingerprints, the windows around those that remain by key with the
windows, and results return to the rows by a digest of the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ALNUM, byte_chunks, checkpointed, gram_hashes, mix, spaced, span_hashes, spans, table, text_or_empty, utf8_rows, whole_row, with_id

GRAM = 5
SPANS = "array<struct<start:bigint,end:bigint>>"
SECOND = np.uint64(0xD6E8FEB86659FD93)  # sets the second window hash apart
ITEM_END, TEXT_END = np.uint64(2), np.uint64(1)  # stand for no word; they differ, so nothing runs over an end


def word_sequence(raw: np.ndarray, at: np.ndarray, lo: int, hi: int, end: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of rows ``lo`` to ``hi``, ``end`` after each row; the place
    where each row begins, and the total."""
    data, row_at = spaced(raw, at, lo, hi)
    low = ALNUM[data]
    start, stop = spans(low != 0)
    row = np.searchsorted(row_at, start, side="right") - 1
    begin = np.zeros(hi - lo + 1, np.int64)
    np.cumsum(np.bincount(row, minlength=hi - lo) + 1, out=begin[1:])
    sequence = np.full(begin[-1], end, np.uint64)
    sequence[np.arange(len(row)) + row] = span_hashes(low, start, stop)
    return sequence, begin


def winnowed(sequence: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the kept grams, and their hashes."""
    k = min(GRAM, window)
    grams, wide = gram_hashes(sequence, k), window - k + 1
    n = len(grams) - wide + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    low, place = grams[:n].copy(), np.zeros(n, np.int8)
    for i in range(1, wide):
        less = grams[i : n + i] < low
        place[less] = i
        np.minimum(low, grams[i : n + i], out=low)
    kept = np.zeros(len(grams), bool)
    kept[np.arange(n) + place] = True
    at = np.flatnonzero(kept)
    return at, grams[at]


def window_hashes(sequence: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every ``length`` consecutive words."""
    return gram_hashes(sequence, length), gram_hashes(mix(sequence + SECOND), length)


def item_sequences(raw: np.ndarray, at: np.ndarray, window: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(row, window length, word hashes) of the items that have words."""
    sequence, begin = word_sequence(raw, at, 0, len(at) - 1, ITEM_END)
    for r, (a, b) in enumerate(zip(begin.tolist(), begin[1:].tolist(), strict=False)):
        if b - 1 > a:
            yield r, min(window, b - 1 - a), sequence[a : b - 1]


def item_windows(bench: DataFrame, window: int) -> DataFrame:
    """(item, length, h1, h2): the windows of every item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for r, length, words in item_sequences(raw, at, window):
                h1, h2 = window_hashes(words, length)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("item").take(pa.array(np.full(len(h1), r))), pa.array(np.full(len(h1), length, np.int32)),
                     pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["item", "length", "h1", "h2"])

    return bench.mapInArrow(work, "item string, length int, h1 long, h2 long")


def item_prints(bench: DataFrame, window: int) -> DataFrame:
    """(length, gram): the distinct fingerprints of the items."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for _, length, words in item_sequences(raw, at, window):
                _, grams = winnowed(words, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), length, np.int32)), pa.array(grams.view(np.int64))], names=["length", "gram"])

    return bench.mapInArrow(work, "length int, gram long").distinct()


@dataclass
class Windows:
    """The windows of one length, by their first hash: second hashes, item sets, and
    the sorted fingerprints."""

    length: int
    h1: np.ndarray
    h2: np.ndarray
    which: np.ndarray
    prints: np.ndarray

    def matches(self, sequence: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``sequence`` where a window stands, and its item set; ``seen``
        are the upper 16 bits of the fingerprints."""
        at, grams = winnowed(sequence, self.length)
        some = seen[grams >> np.uint64(48)]
        at, grams = at[some], grams[some]
        place = np.minimum(np.searchsorted(self.prints, grams), len(self.prints) - 1)
        start = around(at[self.prints[place] == grams], self.length, len(sequence))
        if not len(start):
            return start, start
        words = sequence[start[:, None] + np.arange(self.length)].ravel()
        h1, h2 = (h[:: self.length] for h in window_hashes(words, self.length))
        found = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        same = (self.h1[found] == h1) & (self.h2[found] == h2)
        return start[same], self.which[found[same]]


def around(at: np.ndarray, length: int, n: int) -> np.ndarray:
    """Starts of the windows that contain the grams at some places."""
    back = length - min(GRAM, length)
    start = np.unique((at[:, None] - np.arange(back + 1)[None, :]).ravel())
    return start[(start >= 0) & (start + length <= n)]


def upper_bits(prints: np.ndarray) -> np.ndarray:
    seen = np.zeros(1 << 16, bool)
    seen[prints >> np.uint64(48)] = True
    return seen


def by_broadcast(docs: DataFrame, windows: DataFrame, prints: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, n_words, spans, items) of every document, in one pass."""
    w, p = windows.toArrow(), prints.toArrow()
    column = lambda t, c: t.column(c).to_numpy()
    # a set of items is a number here
    sets_rows = sets.collect()
    numbers = {r.set: k for k, r in enumerate(sets_rows)}
    names = [list(r.items) for r in sets_rows]
    which = np.array([numbers[x] for x in w.column("set").to_pylist()], np.int32)
    tables = []
    for length in np.unique(column(w, "length")).tolist():
        own = column(w, "length") == length
        h1 = column(w, "h1")[own].view(np.uint64)
        by = np.argsort(h1)
        tables.append(Windows(length, h1[by], column(w, "h2")[own].view(np.uint64)[by], which[own][by],
                              np.sort(column(p, "gram")[column(p, "length") == length].view(np.uint64))))
    sent = docs.sparkSession.sparkContext.broadcast((tables, names))
    schema = with_id(docs, "id", f"n_words long, spans {SPANS}, items array<string>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, names = sent.value
        seen = [upper_bits(t.prints) for t in tables]
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for lo, hi in byte_chunks(at, 2 << 20):
                sequence, begin = word_sequence(raw, at, lo, hi, TEXT_END)
                cover = np.zeros(len(sequence) + 1, np.int64)
                found: set[tuple[int, str]] = set()
                for t, bits in zip(tables, seen, strict=True):
                    start, which = t.matches(sequence, bits)
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + t.length, -1)
                    row = np.searchsorted(begin, start, side="right") - 1
                    for r, k in np.unique(np.stack([row, which], 1), axis=0).tolist():
                        found.update((r, i) for i in names[k])
                first, last = spans(np.cumsum(cover) > 0)
                row = np.searchsorted(begin, first, side="right") - 1
                runs: list[list[dict]] = [[] for _ in range(hi - lo)]
                for r, a, b in zip(row.tolist(), first.tolist(), last.tolist(), strict=True):
                    runs[r].append({"start": a - int(begin[r]), "end": b - int(begin[r])})
                items: list[list[str]] = [[] for _ in range(hi - lo)]
                for r, i in sorted(found):
                    items[r].append(i)
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(lo, hi - lo), pa.array(np.diff(begin) - 1, pa.int64()),
                    pa.array(runs, RUNS), pa.array(items, pa.list_(pa.string()))], names=["id", "n_words", "spans", "items"])

    return docs.select("id", "text").mapInArrow(work, schema)


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
BITMAP_BITS = 27


def print_bitmap(prints: DataFrame) -> np.ndarray:
    """One bit for the upper bits of each gram; at most 2**21 words come to the driver."""
    at = F.shiftrightunsigned("gram", 64 - BITMAP_BITS)
    words = prints.groupBy(F.shiftright(at, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def gram_candidates(texts: DataFrame, lengths: list[int], prints: DataFrame) -> DataFrame:
    """(digest, length, gram, starts, h1, h2): the documents' fingerprints that the
    bitmap lets through, each with the windows that contain it."""
    sent = texts.sparkSession.sparkContext.broadcast(print_bitmap(prints))
    kind = pa.schema([("digest", pa.string()), ("length", pa.int32()), ("gram", pa.int64()), ("starts", pa.list_(pa.int64())),
                      ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for lo, hi in byte_chunks(at, 2 << 20):
                sequence, begin = word_sequence(raw, at, lo, hi, TEXT_END)
                digests = batch.column("digest").slice(lo, hi - lo)
                for length in lengths:
                    places, grams = winnowed(sequence, length)
                    top = grams >> np.uint64(64 - BITMAP_BITS)
                    some = bitmap[top >> np.uint64(6)] >> (top & np.uint64(63)) & np.uint64(1) == 1
                    places, grams = places[some], grams[some]
                    row = np.searchsorted(begin, places, side="right") - 1
                    h1, h2 = window_hashes(sequence, length)
                    back = length - min(GRAM, length)
                    first = np.maximum(places - back, begin[row])
                    last = np.minimum(places, begin[row + 1] - 1 - length)
                    own = np.flatnonzero(first <= last)
                    out: dict[str, list] = {f.name: [] for f in kind}
                    for k in own.tolist():
                        a, b, r = int(first[k]), int(last[k]) + 1, int(row[k])
                        for c, v in zip(out.values(), (digests[r].as_py(), length, int(grams[k].view(np.int64)), range(a - int(begin[r]), b - int(begin[r])),
                                                       h1[a:b].view(np.int64), h2[a:b].view(np.int64)), strict=True):
                            c.append(v)
                        if len(out["gram"]) >= 5000:
                            yield pa.RecordBatch.from_pydict(out, schema=kind)
                            out = {c: [] for c in out}
                    yield pa.RecordBatch.from_pydict(out, schema=kind)

    return texts.mapInArrow(work, "digest string, length int, gram long, starts array<long>, h1 array<long>, h2 array<long>")


def by_join(docs: DataFrame, windows: DataFrame, prints: DataFrame, sets: DataFrame) -> DataFrame:
    """(digest, spans, items) of the texts with hits, by joins on fingerprints and
    windows."""
    lengths = sorted(r[0] for r in prints.select("length").distinct().collect())  # at most as many as window lengths
    near = gram_candidates(docs.select("digest", "text"), lengths, prints).join(prints, ["length", "gram"], "left_semi")
    each = near.select("digest", "length", F.explode(F.arrays_zip("starts", "h1", "h2")).alias("w")).select(
        "digest", "length", F.col("w.starts").alias("start"), "w.h1", "w.h2").distinct()
    hits = checkpointed(each.join(windows, ["length", "h1", "h2"]).select("digest", "start", (F.col("start") + F.col("length")).alias("end"), "set"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for own in batch.column("all").to_pylist():
                runs: list[dict] = []
                for r in sorted(own, key=lambda r: (r["start"], r["end"])):
                    if runs and r["start"] <= runs[-1]["end"]:
                        runs[-1]["end"] = max(runs[-1]["end"], r["end"])
                    else:
                        runs.append(r)
                out.append(runs)
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(out, RUNS)], names=["digest", "spans"])

    runs = hits.groupBy("digest").agg(F.collect_set(F.struct("start", "end")).alias("all")).mapInArrow(merge, f"digest string, spans {SPANS}")
    items = hits.select("digest", "set").distinct().join(sets, "set").groupBy("digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return runs.join(items, "digest")


def word_counts(docs: DataFrame) -> DataFrame:
    """(id, digest, n_words) of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for lo, hi in byte_chunks(at, 2 << 20):
                data, row_at = spaced(raw, at, lo, hi)
                start, _ = spans(ALNUM[data] != 0)
                n = np.bincount(np.searchsorted(row_at, start, side="right") - 1, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(lo, hi - lo), batch.column("digest").slice(lo, hi - lo), pa.array(n, pa.int64())],
                    names=["id", "digest", "n_words"])

    return docs.mapInArrow(work, with_id(docs, "id", "digest string, n_words long"))


def benchmark_tables(benchmark: DataFrame, window: int, item_col: str, item_text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """The benchmark's windows (length, h1, h2, set), prints (length, gram) and item
    sets (set, items), and the size of all that in bytes."""
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"), text_or_empty(item_text_col).alias("text")).distinct()
    of_window = item_windows(bench, window).groupBy("length", "h1", "h2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    named = checkpointed(of_window.withColumn("set", F.md5(F.to_json("items"))))
    windows = named.select("length", "h1", "h2", "set")
    sets = checkpointed(named.groupBy("set").agg(F.first("items").alias("items")))
    prints = checkpointed(item_prints(bench, window))
    text = F.coalesce(F.aggregate("items", F.lit(0).cast("long"), lambda n, i: n + 50 + F.octet_length(i)), F.lit(0).cast("long"))
    size = 56 * windows.count() + 8 * prints.count() + (sets.agg(F.sum(text + 100)).first()[0] or 0)
    return windows, prints, sets, size


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """(id, n_words, spans, items): one row per row of ``docs``.

    spans are the maximal runs of hit words (word numbers, end exclusive), items
    the distinct item ids with an occurring window, as sorted strings. Null and
    empty texts have no words and no hits; an item with a null id hits but is
    not listed; repeated rows and items change nothing else; an empty benchmark
    hits nothing. Other columns are not read."""
    *tables, size = benchmark_tables(benchmark, window, item_col, item_text_col)
    docs = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    if size <= broadcast_bytes:
        return by_broadcast(docs, *tables)
    docs = docs.withColumn("digest", F.md5("text"))
    found = by_join(docs, *tables)
    return word_counts(docs).join(found, "digest", "left").select(
        "id", "n_words", F.coalesce("spans", F.expr(f"cast(array() as {SPANS})")).alias("spans"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 10,
                      item_col: str = "item_id", item_text_col: str = "text", broadcast_bytes: int = 32 << 20) -> DataFrame:
    """``docs``, all columns, without the documents that hold a window. Rows are
    judged by their text, so rows with a null id are judged too."""
    *tables, size = benchmark_tables(benchmark, window, item_col, item_text_col)
    packed = docs.select(whole_row(docs).alias("id"), text_or_empty(text_col).alias("text"))
    if size <= broadcast_bytes:
        return by_broadcast(packed, *tables).where(F.size("spans") == 0).select("id.*")
    packed = packed.withColumn("digest", F.md5("text"))
    return packed.join(by_join(packed, *tables).select("digest"), "digest", "left_anti").select("id.*")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every row of ``documents`` against all of ``benchmark``."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


OP3_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM items WHERE len(w) > 0)
), doc_windows AS (
    SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n)
), hits AS (
    SELECT d.doc_id, d.i, d.n, t.item_id FROM doc_windows d JOIN item_windows t ON d.n = t.n AND d.win = t.win
), hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
        SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.joined, '')) AS items_sha256,
    coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items i USING (doc_id)
"""
