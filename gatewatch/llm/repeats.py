"""Removal of repeated byte strings, by suffix arrays over shared text.

Every byte covered by a string of ``span`` bytes that also starts anywhere else
goes. The windows (all strings of ``span`` bytes of a text) are dealt to tasks so
that equal ones meet: the key of a window is the smallest hash of its
``gram``-byte strings, and a run of windows with one key is a segment. A key
that occurs at one place only holds no repeat; its text is not moved. Exact
copies of a text are found by their digest and stand in once.

A task takes whole keys. Equal segments are one. The text is cut at
content-defined places (where a hash of 8 bytes is divisible by 32) into
phrases, and the phrases of all segments, with a distinct symbol between
segments, get a suffix array by the grouping construction of ``suffixes``. A
window is the end of a phrase, a run of whole phrases, and a beginning. Two
windows are equal if their ends and beginnings are (by 64-bit hashes) and the
runs are as long and common prefixes along the suffix array do not fall below
that length between them. Windows of one class with two or more places repeat.

A key with over ``max_segments`` segments is dealt by content: the windows get a
longer key. The string of the key grows inside the window by half of what is
missing to the whole window, on the side where more is missing; that is a level.
Equal windows grow alike, so they still meet; windows that differ near the string
part. Equal pieces of a longer key become one, with the number of their places.
Keys with more than ``max_segments`` different ones grow again, some levels at a
time, after about log2(span - gram) levels to the whole window, where all windows
of a key are equal and nothing is left to compare. Only texts with such keys are
read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, BASE_INV, byte_chunks, checkpointed, mix, powers, spans, table, utf8_rows
from .suffixes import RangeMinimum, common_prefixes, suffix_array

ANCHOR, EVERY = 8, 32
SECOND = 0xC2B2AE3D27D4EB4F  # the base of the second hash
CHUNK = 1 << 20
SALTS = 16


class Rolling:
    """Hashes of any spans of some bytes."""

    def __init__(self, data: np.ndarray, base: int = BASE) -> None:
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(base, len(data)), out=self.total[1:])
        self.back = powers(BASE_INV if base == BASE else pow(base, -1, 1 << 64), len(data) + 1)

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.total[hi] - self.total[lo]) * self.back[lo])

    def all(self, size: int) -> np.ndarray:
        """The hash of every ``size`` consecutive bytes."""
        n = max(0, len(self.total) - size)
        return mix((self.total[size : size + n] - self.total[:n]) * self.back[:n])


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def segments(raw: np.ndarray, at: np.ndarray, lo: int, hi: int, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(row, first window, end of windows, key, whether the key's string stands
    twice in the segment) of the rows ``lo`` to ``hi``; window numbers count from
    the start of their row."""
    data = raw[at[lo] : at[hi]]
    empty = np.zeros(0, np.int64)
    if len(data) < span:
        return empty, empty, empty, np.zeros(0, np.uint64), np.zeros(0, bool)
    hashes = Rolling(data).all(gram)
    key = sliding_minimum(hashes, span - gram + 1)
    start = at[lo : hi + 1] - at[lo]
    fine = np.zeros(len(key) + 1, bool)
    row_of = np.repeat(np.arange(lo, hi), np.diff(start))[: len(key)]
    fine[:-1] = np.arange(len(key)) + span <= start[1:][row_of - lo]
    new = np.ones(len(key) + 1, bool)
    new[1:-1] = (key[1:] != key[:-1]) | (row_of[1:] != row_of[:-1])
    edge = np.flatnonzero(new | (np.diff(fine.astype(np.int8), prepend=0) != 0))
    first, end = edge[:-1], edge[1:]
    own = fine[first]
    first, end = first[own], end[own]
    row = row_of[first]
    base = start[row - lo]
    known, number = np.unique(key[first], return_inverse=True)
    seen = np.zeros(1 << 16, bool)
    seen[known >> np.uint64(48)] = True
    at_key = np.flatnonzero(seen[hashes >> np.uint64(48)])
    which = np.minimum(np.searchsorted(known, hashes[at_key]), len(known) - 1)
    at_key, which = at_key[hit := known[which] == hashes[at_key]], which[hit]
    places = np.sort(which * len(data) + at_key)
    stands = np.searchsorted(places, number * len(data) + end + span - gram) - np.searchsorted(places, number * len(data) + first)
    return row, first - base, end - base, key[first], stands > 1


def keyed_segments(texts: DataFrame, span: int, gram: int) -> DataFrame:
    """(cid, lo, hi, key, twice) of the segments of every text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for lo, hi in byte_chunks(at, CHUNK):
                row, first, end, key, twice = segments(raw, at, lo, hi, span, gram)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("cid").take(pa.array(row)), pa.array(first.astype(np.int32)), pa.array(end.astype(np.int32)),
                     pa.array(key.view(np.int64)), pa.array(twice)], names=["cid", "lo", "hi", "key", "twice"])

    return texts.mapInArrow(work, "cid binary, lo int, hi int, key long, twice boolean")


def once_per_task(texts: DataFrame) -> DataFrame:
    """``texts`` without repeats of a cid within a task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for i, cid in enumerate(batch.column("cid").to_pylist()):
                if cid not in seen:
                    seen.add(cid)
                    new.append(i)
            yield batch if len(new) == batch.num_rows else batch.take(pa.array(new, pa.int64()))

    return texts.mapInArrow(work, texts.schema)


def repeated_windows(data: np.ndarray, begin: np.ndarray, first: np.ndarray, count: np.ndarray, times: np.ndarray,
                     span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes of the windows of some segments.

    Segment k is data[begin[k]:begin[k + 1]]; it owns the ``count[k]`` windows
    from its byte ``first[k]`` on and stands ``times[k]`` times in the corpus.
    Returns the place in ``data`` and the segment of each window, and the number
    of corpus places of its class."""
    seg = np.repeat(np.arange(len(first)), count)
    p = np.repeat(begin[:-1] + first - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(len(seg))
    roll = Rolling(data)
    anchor = np.flatnonzero(roll.all(ANCHOR) % np.uint64(EVERY) == 0)
    owner = np.searchsorted(begin, anchor, side="right") - 1
    anchor, owner = anchor[keep := anchor + ANCHOR <= begin[owner + 1]], owner[keep]
    # symbols: phrases from anchor to anchor, the last one of a segment is its end
    last = np.append(owner[1:] != owner[:-1], True) if len(anchor) else np.zeros(0, bool)
    to = np.append(anchor[1:], 0) if len(anchor) else anchor
    to = np.where(last, begin[owner + 1], to)
    _, symbol = np.unique(roll(anchor, to), return_inverse=True)
    symbol = symbol + len(first)
    symbol[last] = owner[last]  # a distinct one for each segment
    sequence = symbol.tolist()
    order = suffix_array(sequence)
    low = RangeMinimum(np.array(common_prefixes(sequence, order) or [0]))
    rank = np.zeros(len(sequence) + 1, np.int64)
    rank[np.array(order, np.int64)] = np.arange(len(order))
    a = np.searchsorted(anchor, p)
    b = np.searchsorted(anchor, p + span - ANCHOR, side="right") - 1
    some = b >= a
    a_at = np.where(some, np.append(anchor, 0)[np.minimum(a, len(anchor))], p + span)
    b_at = np.where(some, np.append(anchor, 0)[np.maximum(b, 0)], p + span)
    phrases = np.where(some, b - a, 0)
    ends = mix(roll(p, a_at) * np.uint64(SECOND) + mix(roll(b_at, p + span) + (a_at - p).astype(np.uint64) * np.uint64(BASE)))
    place = np.where(phrases > 0, rank[np.minimum(a, len(sequence))], 0)
    by = np.lexsort((place, phrases, ends))
    x, y = by[:-1], by[1:]
    same = (ends[x] == ends[y]) & (phrases[x] == phrases[y])
    look = np.flatnonzero(same & (place[x] != place[y]))
    same[look] = low(place[x[look]] + 1, place[y[look]] + 1) >= phrases[x[look]]
    number = np.concatenate(([0], np.cumsum(~same))) if len(by) else np.zeros(0, np.int64)
    size = np.bincount(number, times[seg[by]]).astype(np.int64) if len(by) else np.zeros(0, np.int64)
    total = np.zeros(len(seg), np.int64)
    total[by] = size[number]
    return p, seg, total


def covered(first: np.ndarray, span: int) -> list[tuple[int, int]]:
    """Ranges of bytes under windows that start at the sorted ``first``."""
    if not len(first):
        return []
    cut = np.flatnonzero(np.diff(first) > span)
    return list(zip(first[np.append(0, cut + 1)].tolist(), (first[np.append(cut, len(first) - 1)] + span).tolist(), strict=True))


def levels(span: int, gram: int) -> int:
    """How often a key of ``gram`` bytes grows until it is the whole window."""
    n, missing = 0, span - gram
    while missing:
        n, missing = n + 1, missing // 2
    return n


def cut_levels(span: int, gram: int) -> list[int]:
    """The levels at which large keys are cut; the last one is the whole window."""
    whole = levels(span, gram)
    return [*range(2, whole, 3), whole]


def grown(data: np.ndarray, count: int, key: int, level: int, span: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first, end, key, twice) of the runs of windows with one key of ``level``
    among the ``count`` windows of a segment of ``key``; window numbers count from
    the start of the segment."""
    roll = Rolling(data)
    w = np.arange(count)
    stands = np.flatnonzero(roll.all(gram) == np.uint64(key))
    lo = stands[np.searchsorted(stands, w)]  # the key's first string in each window
    hi = lo + gram
    for _ in range(level):
        right = w + span - hi
        more = (lo - w + right + 1) // 2
        to_right = right >= more
        hi, lo = hi + np.where(to_right, more, 0), lo - np.where(to_right, 0, more)
    new_key = mix(roll(lo, hi) + np.uint64((key * 31 + level) % (1 << 64)))
    edge = np.flatnonzero(np.append(True, new_key[1:] != new_key[:-1]))
    end = np.append(edge[1:], count)
    twice = np.minimum.reduceat(lo, edge) != np.maximum.reduceat(lo, edge)
    return edge, end, new_key[edge], twice


PIECES = pa.schema([("cid", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("key", pa.int64()), ("first_key", pa.int64()),
                    ("twice", pa.bool_()), ("piece", pa.binary()), ("bytes", pa.binary())])
PIECES_DDL = "cid binary, lo int, hi int, key long, first_key long, twice boolean, piece binary, bytes binary"


def piece_of(key: int, data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16, key=key.to_bytes(8, "little", signed=True)).digest()


def cut_pieces(segs: DataFrame, level: int, span: int, gram: int) -> DataFrame:
    """Pieces of the segments cut at keys of ``level``; piece tells those with
    other bytes or another key apart. ``segs`` are the large segments of a text
    (cid, text, segs) or pieces of a lower level."""

    def parts(batch: pa.RecordBatch) -> Iterator[tuple]:
        if "segs" in batch.schema.names:
            for cid, text, own in zip(batch.column("cid").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                                      batch.column("segs").to_pylist(), strict=True):
                for s in own:
                    yield cid, s["lo"], s["hi"], s["first_key"], text[s["lo"] : s["hi"] - 1 + span]
        else:
            yield from zip(*(batch.column(c).to_pylist() for c in ("cid", "lo", "hi", "first_key", "bytes")), strict=True)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {k: [] for k in PIECES.names}
        for batch in batches:
            for cid, lo, hi, first_key, data in parts(batch):
                found = grown(np.frombuffer(data, np.uint8), hi - lo, first_key % (1 << 64), level, span, gram)
                for a, b, key, twice in zip(*(x.tolist() for x in found), strict=True):
                    key = key - (1 << 64) if key >= 1 << 63 else key
                    part = data[a : b - 1 + span]
                    for c, v in zip(out.values(), (cid, lo + a, lo + b, key, first_key, twice, piece_of(key, part), part), strict=True):
                        c.append(v)
                if len(out["cid"]) >= 4000:
                    yield pa.RecordBatch.from_pydict(out, schema=PIECES)
                    out = {k: [] for k in out}
        yield pa.RecordBatch.from_pydict(out, schema=PIECES)

    return segs.mapInArrow(work, PIECES_DDL)


def dealt_by_content(hot: DataFrame, span: int, gram: int, max_segments: int) -> tuple[list[DataFrame], list[DataFrame], list[DataFrame]]:
    """The large keys' segments, by longer keys.

    Returns parts of three tables: (key, piece, times, cid, lo, count, bytes), one
    segment of every kind with its number of places, for keys that are small enough
    now; (piece, cid, lo), all places of these; and (cid, start, end), ranges that
    repeat for sure, of keys that have become whole windows. A cut takes several
    levels at once (``cut_levels``), the first one included: each costs the same few
    shuffles. Texts do not move: from the first cut on the pieces of keys that are
    still too large carry their bytes."""
    kinds, places, sure = [], [], []
    left, whole = hot, levels(span, gram)
    for level in cut_levels(span, gram):
        each = checkpointed(cut_pieces(left, level, span, gram))
        if level == whole:
            keys = each.groupBy("key").agg(F.count("*").alias("n"), F.max("twice").alias("twice")).where("n > 1 or twice")
            sure.append(each.join(keys.select("key"), "key", "left_semi").select(
                "cid", F.col("lo").cast("long").alias("start"), (F.col("hi") - 1 + span).cast("long").alias("end")))
            break
        alike = each.groupBy("key", "piece").agg(F.count("*").alias("times"), F.max("twice").alias("twice"))
        keys = alike.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("times").alias("n"), F.max("twice").alias("twice"))
        keys = checkpointed(keys.where("n > 1 or twice").select("key", (F.col("kinds") > max_segments).alias("large")))
        small = keys.where(~F.col("large")).select("key")
        places.append(each.join(small, "key", "left_semi").select("piece", "cid", "lo"))
        # an inner join stays above the grouping, so a key moves its kinds and not all its places
        kinds.append(each.groupBy("key", "piece").agg(
            F.count("*").alias("times"), F.min(F.struct("cid", "lo", "hi")).alias("one"), F.first("bytes").alias("bytes")).join(
            small, "key").select(
            "key", "piece", "times", "one.cid", "one.lo", (F.col("one.hi") - F.col("one.lo")).alias("count"), "bytes"))
        large = keys.where("large").select("key")
        if large.isEmpty():
            break
        left = each.join(large, "key", "left_semi")
    return kinds, places, sure


def found_ranges(pieces: DataFrame, span: int) -> DataFrame:
    """(cid, piece, start, end): ranges of repeated bytes, from the segment's
    start on where the segment stands for a piece."""

    def solve(rows: list[dict]) -> pa.RecordBatch:
        alike: dict[tuple[bytes, int], list[dict]] = {}
        for r in rows:
            alike.setdefault((r["bytes"], r["count"]), []).append(r)
        distinct = list(alike)
        begin = np.concatenate(([0], np.cumsum([len(b) for b, _ in distinct])))
        data = np.frombuffer(b"".join(b for b, _ in distinct), np.uint8)
        times = np.array([sum(r["times"] for r in alike[d]) for d in distinct])
        p, seg, total = repeated_windows(data, begin, np.zeros(len(distinct), np.int64), np.array([c for _, c in distinct]), times, span)
        out: tuple[list, ...] = ([], [], [], [])
        bounds = np.searchsorted(seg, np.arange(len(distinct) + 1))
        for k, d in enumerate(distinct):
            own = slice(bounds[k], bounds[k + 1])
            twice = p[own][total[own] > 1] - begin[k]
            for lo, hi in covered(twice, span):
                for r in alike[d]:
                    at = 0 if r["piece"] is not None else r["lo"]
                    for c, v in zip(out, (r["cid"], r["piece"], at + lo, at + hi), strict=True):
                        c.append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.binary()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.int64()),
                                           pa.array(out[3], pa.int64())], names=["cid", "piece", "start", "end"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                if held and size > 2_000_000 and r["key"] != held[-1]["key"]:
                    yield solve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r["bytes"])
        if held:
            yield solve(held)

    return pieces.repartition("key").sortWithinPartitions("key").mapInArrow(work, "cid binary, piece binary, start long, end long")


def remaining(texts: DataFrame, ranges: DataFrame) -> DataFrame:
    """(cid, n_removed, n_spans, kept, kept_sha256) of the texts with ranges to remove."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for text, marks in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                gone = np.zeros(len(text) + 1, np.int32)
                np.add.at(gone, [m["start"] for m in marks], 1)
                np.add.at(gone, [m["end"] for m in marks], -1)
                dead = np.cumsum(gone[:-1]) > 0
                kept = np.frombuffer(text, np.uint8)[~dead].tobytes()
                for c, v in zip(out, (int(dead.sum()), len(spans(dead)[0]), kept, hashlib.sha256(kept).hexdigest()), strict=True):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                 pa.array(out[3], pa.string())], names=["cid", "n_removed", "n_spans", "kept", "kept_sha256"])

    lists = ranges.groupBy("cid").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))
    return texts.join(lists, "cid").select("cid", "text", "ranges").mapInArrow(
        work, "cid binary, n_removed long, n_spans long, kept binary, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = 400, gram: int = 128,
                   max_segments: int = 512) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept, kept_sha256): one row per row.

    kept is null where nothing is removed. Null and empty texts, and texts under
    ``span`` bytes, lose nothing. Of copies of a longer text, repeated rows
    included, all bytes go. A null id keeps its row; other columns are not read."""
    gram = min(gram, span)
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("sha", F.sha2("text", 256))
    cid = F.unhex(F.substring("sha", 1, 32)).alias("cid")
    # the salt spreads the copies of one text over tasks of the join below
    rows = checkpointed(base.select("id", "sha", F.octet_length("text").cast("long").alias("n_bytes"),
                                    F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt")))
    texts = base.where(F.octet_length("text") >= span).select(cid, "text")
    # a key is worth moving if two different places have it
    place = F.xxhash64("cid", "lo")
    segs = keyed_segments(texts, span, gram)
    keys = segs.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("twice").alias("twice"), F.count("*").alias("n")).where("a <> b or twice")
    shared = segs.join(keys.select("key", (F.col("n") > max_segments).alias("hot")), "key")
    lists = shared.groupBy("cid").agg(F.collect_set(F.struct("lo", "hi", F.col("key").alias("first_key"), "twice", "hot")).alias("segs"))
    # of several tasks' copies one text stays
    joined = once_per_task(texts).join(lists, "cid").dropDuplicates(["cid"])
    joined = checkpointed(joined)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in kind.names}
            for c, text_, segs_ in zip(batch.column("cid").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(),
                                       batch.column("segs").to_pylist(), strict=True):
                for s in segs_:
                    piece = text_[s["lo"] : s["hi"] - 1 + span]
                    for k, v in zip(out, (s["key"], s["piece"], s["times"], c, s["lo"], s["hi"] - s["lo"], piece), strict=True):
                        out[k].append(v)
                    if len(out["cid"]) >= 2000:
                        yield pa.RecordBatch.from_pydict(out, schema=kind)
                        out = {k: [] for k in out}
            yield pa.RecordBatch.from_pydict(out, schema=kind)

    kind = pa.schema([("key", pa.int64()), ("piece", pa.binary()), ("times", pa.int64()), ("cid", pa.binary()), ("lo", pa.int32()),
                      ("count", pa.int32()), ("bytes", pa.binary())])
    cuts = "key long, piece binary, times long, cid binary, lo int, count int, bytes binary"
    plain = F.transform(F.filter("segs", lambda s: ~s.hot), lambda s: F.struct(
        s.lo.alias("lo"), s.hi.alias("hi"), s.first_key.alias("key"), F.lit(1).cast("long").alias("times"),
        F.lit(None).cast("binary").alias("piece")))
    pieces = joined.select("cid", "text", plain.alias("segs")).mapInArrow(cut, cuts)
    large = joined.select("cid", "text", F.filter("segs", lambda s: s.hot).alias("segs")).where(F.size("segs") > 0)
    kinds, places, sure = ([], [], []) if large.isEmpty() else dealt_by_content(large, span, gram, max_segments)
    for k in kinds:
        pieces = pieces.unionByName(k)
    found = checkpointed(found_ranges(pieces, span))
    ranges = found.where("piece is null").select("cid", "start", "end")
    if places:
        of_piece = found.where("piece is not null").select("piece", "start", "end")
        ranges = ranges.unionByName(reduce(DataFrame.unionByName, places).join(of_piece, "piece").select(
            "cid", (F.col("lo") + F.col("start")).alias("start"), (F.col("lo") + F.col("end")).alias("end")))
    for r in sure:
        ranges = ranges.unionByName(r)
    solved = remaining(joined.select("cid", "text"), ranges)
    copies = rows.where(F.col("n_bytes") >= span).groupBy("sha").agg(F.count("*").alias("copies")).where("copies > 1")
    copies = copies.select("sha", "copies", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    marked = rows.join(copies, ["sha", "salt"], "left").withColumn("cid", F.unhex(F.substring("sha", 1, 32)))
    columns = ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    nothing = F.lit(0).cast("long")
    # of copies all bytes go, short texts stay; other texts stand once, so their join by text is even
    gone = marked.where(F.col("copies").isNotNull()).select(
        "id", "n_bytes", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), F.lit(b"").alias("kept"),
        F.sha2(F.lit(b""), 256).alias("kept_sha256"))
    short = marked.where(F.col("n_bytes") < span).select(
        "id", "n_bytes", nothing.alias("n_removed"), nothing.alias("n_spans"), F.lit(None).cast("binary").alias("kept"), F.col("sha").alias("kept_sha256"))
    single = marked.where(F.col("copies").isNull() & (F.col("n_bytes") >= span)).join(solved, "cid", "left").select(
        "id", "n_bytes", F.coalesce("n_removed", nothing).alias("n_removed"), F.coalesce("n_spans", nothing).alias("n_spans"), "kept",
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"))
    return gone.select(*columns).unionByName(short.select(*columns)).unionByName(single.select(*columns))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated bytes of every row of ``documents``."""
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
