"""SimHash near-duplicates by a binary-trie self-join.

Fingerprints: a text is lower-cased (A-Z) and cut into words
``[^\\x20\\x09-\\x0D]+``; every 3-word shingle, repeats included, is hashed with
XXH64 (seed 42); bit i of the fingerprint is set if it is set in over half the
hashes. Fewer words than a shingle: the whole word sequence is the one shingle;
no words: fingerprint zero.

Links: two fingerprints link at ``max_bits`` or fewer differing bits. Equal
fingerprints are collapsed first. The 64 bits are cut into ``max_bits + 1``
blocks; two linked fingerprints agree in at least one block, so each
fingerprint is dealt once per block by that block's value, and every group is a
pair (node, same node) of the trie whose first bits are that block. The group is
joined with itself by walking node pairs downwards together: a pair of nodes
carries the bits in which its members already differ and is dropped when these
exceed the budget. A group with over ``max_unit`` fingerprints is first split
into the pairs of its child nodes six bits further down, again and again, so no
task ever holds more than a bounded piece of the trie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import byte_chunks, checkpointed, components, forest, table, text_or_empty, utf8_rows, whole_row, with_id

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPLIT_BITS = 6


def shingle_hashes(text: bytes, n: int = 3) -> np.ndarray:
    """XXH64 (seed 42) of each ``n``-word shingle of a text."""
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    grams = zip(*(words[i:] for i in range(n)), strict=False) if len(words) >= n else [words]
    return np.array([xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams], np.uint64)


def majority_bits(hashes: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per row, the bits set in over half of its hashes; ``start`` holds the
    first hash of each row and the total. A row without hashes is zero."""
    rows = np.flatnonzero(np.diff(start))
    out = np.zeros(len(start) - 1, np.uint64)
    if not len(rows):
        return out
    half = np.diff(start)[rows]
    lanes = np.uint64(0x0000000100000001)  # two 32-bit counters at a time
    for bit in range(32):
        counts = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, start[rows])
        low, high = counts & np.uint64(0xFFFFFFFF), counts >> np.uint64(32)
        out[rows] |= (low.astype(np.int64) * 2 > half).astype(np.uint64) << np.uint64(bit)
        out[rows] |= (high.astype(np.int64) * 2 > half).astype(np.uint64) << np.uint64(bit + 32)
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp): one row per row of ``docs``; fp is the fingerprint as a signed
    long. A null text counts as empty."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, at = utf8_rows(batch.column(1))
            found = []
            for lo, hi in byte_chunks(at, 1 << 20):
                each = [shingle_hashes(raw[at[r] : at[r + 1]].tobytes(), shingle) for r in range(lo, hi)]
                start = np.concatenate(([0], np.cumsum([len(x) for x in each])))
                found.append(majority_bits(np.concatenate(each), start))
            fp = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(work, with_id(docs, id_col, "fp long"))


def rotate(fp: np.ndarray, bits: int) -> np.ndarray:
    """``fp`` turned left by ``bits``."""
    return fp if bits == 0 else (fp << np.uint64(bits)) | (fp >> np.uint64(64 - bits))


def trie_pairs(fp: np.ndarray, start: np.ndarray, stop: np.ndarray, other: np.ndarray, other_stop: np.ndarray,
               budget: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of positions whose values differ in at most the budget's bits.

    ``fp`` is sorted within each range. Range pair k joins [start, stop) with
    [other, other_stop); where both are the same range, each pair comes once.
    Node pairs go down one bit at a time and are dropped over the budget."""
    a0, a1, b0, b1, left = start, stop, other, other_stop, budget.astype(np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for bit in range(63, -1, -1):
        same = a0 == b0
        live = (a1 > a0) & (b1 > b0) & (left >= 0) & ~(same & (a1 - a0 < 2))
        single = live & ~same & (a1 - a0 == 1) & (b1 - b0 == 1)
        if single.any():
            x, y, most = a0[single], b0[single], left[single]
            low = np.uint64((1 << (bit + 1)) - 1) if bit < 63 else np.uint64(0xFFFFFFFFFFFFFFFF)
            near = np.bitwise_count((fp[x] ^ fp[y]) & low) <= most
            found.append((x[near], y[near]))
            live &= ~single
        if not live.any():
            break
        a0, a1, b0, b1, left, same = a0[live], a1[live], b0[live], b1[live], left[live], same[live]
        zeros = np.concatenate(([0], np.cumsum((fp >> np.uint64(bit)) & np.uint64(1) == 0)))
        am, bm = a0 + zeros[a1] - zeros[a0], b0 + zeros[b1] - zeros[b0]
        apart = ~same
        a0, a1, b0, b1, left = (np.concatenate(x) for x in zip(
            (a0, am, b0, bm, left), (am, a1, bm, b1, left), (a0, am, bm, b1, left - 1),
            (am[apart], a1[apart], b0[apart], bm[apart], left[apart] - 1), strict=True))
    else:
        both = (a1 > a0) & (b1 > b0) & (left >= 0) & (a0 != b0)
        found.append((a0[both], b0[both]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found])


def split_units(units: DataFrame) -> DataFrame:
    """Units replaced by the node pairs ``SPLIT_BITS`` further down whose
    members can still be within the budget."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = np.arange(1 << SPLIT_BITS)
        for batch in batches:
            turned = batch.column("turned").to_numpy(zero_copy_only=False).view(np.uint64)
            depth = batch.column("depth").to_numpy(zero_copy_only=False).astype(np.int64)
            left = batch.column("budget").to_numpy(zero_copy_only=False).astype(np.int64)
            side = batch.column("side").to_numpy(zero_copy_only=False).astype(np.int64)
            step = np.minimum(SPLIT_BITS, 64 - depth)
            own = (turned << depth.astype(np.uint64)) >> np.uint64(64 - SPLIT_BITS)
            own = (own.astype(np.int64) >> (SPLIT_BITS - step))
            differ = np.bitwise_count(own[:, None] ^ values[None, :]).astype(np.int64)
            row, value = np.nonzero((differ <= left[:, None]) & (values[None, :] < (1 << step)[:, None]))
            mine, into = own[row], side[row]
            whole = into == 2
            into = np.where(whole, np.where(mine < value, 0, np.where(mine > value, 1, 2)), into)
            first = np.where(whole, np.minimum(mine, value), np.where(into == 0, mine, value))
            second = np.where(whole, np.maximum(mine, value), np.where(into == 0, value, mine))
            path = [f"{u}.{a}-{b}" for u, a, b in zip(
                batch.column("unit").take(pa.array(row)).to_pylist(), first.tolist(), second.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array(path, pa.string()), pa.array(turned[row].view(np.int64)),
                batch.column("turn").take(pa.array(row)), pa.array((depth + step)[row], pa.int32()),
                pa.array((left[row] - differ[row, value]), pa.int32()), pa.array(into, pa.int32())],
                names=["unit", "turned", "turn", "depth", "budget", "side"])

    return units.mapInArrow(work, units.schema)


def unit_links(units: DataFrame) -> DataFrame:
    """Links (a, b) between fingerprints of the same unit; per batch of units
    only a spanning forest of what the trie walk finds."""

    def solve(unit: np.ndarray, turned: np.ndarray, turn: np.ndarray, depth: np.ndarray, budget: np.ndarray,
              side: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate(([True], np.diff(unit) != 0)))
        last = np.append(first[1:], len(unit))
        mid = first + np.add.reduceat((side != 1).astype(np.int64), first)
        whole = side[first] == 2
        below = (turned << depth.astype(np.uint64)) >> depth.astype(np.uint64)  # the budget counts the bits above
        below[depth >= 64] = 0
        a, b = trie_pairs(below, first, np.where(whole, last, mid), np.where(whole, first, mid), last, budget[first])
        plain = np.zeros(len(turned), np.uint64)
        for t in np.unique(turn):
            plain[turn == t] = rotate(turned[turn == t], int(64 - t) % 64)
        values, back = np.unique(plain, return_inverse=True)
        root = forest(len(values), back[a], back[b])
        linked = np.flatnonzero(root != np.arange(len(values)))
        return pa.RecordBatch.from_arrays(
            [pa.array(values[linked].view(np.int64)), pa.array(values[root[linked]].view(np.int64))], names=["a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(rows: pa.Table) -> pa.RecordBatch:
            number = rows.column("unit").combine_chunks().dictionary_encode().indices.to_numpy()
            col = lambda c: rows.column(c).to_numpy()
            return solve(number, col("turned").view(np.uint64), col("turn"), col("depth"), col("budget"), col("side"))

        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 200_000:
                continue
            rows = pa.Table.from_batches(held)
            names = rows.column("unit").combine_chunks()
            end = names.index(names[len(names) - 1]).as_py()  # the last unit may go on
            if end:
                yield flush(rows.slice(0, end))
            held, size = rows.slice(end).to_batches(), len(rows) - end
        if size:
            yield flush(pa.Table.from_batches(held))

    # An order by the unsigned value: a signed long with its top bit turned.
    order = F.col("turned").bitwiseXOR(F.lit(-(1 << 63)))
    dealt = units.repartition("unit").sortWithinPartitions("unit", F.col("side") == 1, order)
    return dealt.mapInArrow(work, "a long, b long")


def links(prints: DataFrame, max_bits: int = 2, max_unit: int = 50_000) -> DataFrame:
    """Links (a, b) that connect whatever fingerprints are within ``max_bits``.

    ``prints`` has one distinct long column ``fp``. The links are a subset of
    all pairs within the distance with the same connected components."""
    cuts = [64 * i // (max_bits + 1) for i in range(max_bits + 2)]
    units = prints.select(F.explode(F.array(*[
        F.struct(
            F.lit(lo).alias("turn"), F.lit(hi - lo).alias("depth"),
            (F.shiftleft("fp", lo).bitwiseOR(F.shiftrightunsigned("fp", 64 - lo)) if lo else F.col("fp")).alias("turned"),
        ) for lo, hi in zip(cuts, cuts[1:], strict=False)])).alias("u")).select("u.*")
    units = units.select(
        F.concat(F.col("turn").cast("string"), F.lit(":"), F.hex(F.expr("shiftrightunsigned(turned, 64 - depth)"))).alias("unit"),
        "turned", "turn", "depth", F.lit(max_bits).alias("budget"), F.lit(2).alias("side"))
    while True:
        hot = units.groupBy("unit", "depth").count().where((F.col("count") > max_unit) & (F.col("depth") < 64)).select("unit")
        hot = checkpointed(hot)
        if hot.isEmpty():
            return unit_links(units)
        marked = units.join(hot.withColumn("_hot", F.lit(True)), "unit", "left")
        cold = marked.where("_hot is null").drop("_hot")
        units = checkpointed(cold.unionByName(split_units(marked.where("_hot").drop("_hot"))))


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                   max_bits: int = 2, max_unit: int = 50_000) -> DataFrame:
    """(id, fp, component): one row per row of ``docs``.

    component is the smallest id whose fingerprint can be reached over links.
    Null or empty text: fingerprint zero, linked like any other. A null id keeps
    its row and counts for no minimum (a group of null ids only has a null
    component). Repeated rows are kept. An empty table gives no rows. Columns
    other than the two named ones are not read."""
    prints = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    distinct = prints.groupBy("fp").agg(F.min("id").alias("low"))
    found = components(links(distinct.select("fp"), max_bits, max_unit))
    rooted = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component"))
    by_print = rooted.join(lowest, "root").select("fp", "component")
    return prints.join(by_print, "fp").select("id", "fp", "component")


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with all its columns: of each group the row with the smallest id
    and, under one id, the smallest text hash. Rows with a null id stay."""
    id_and_print = F.struct(F.col(id_col).alias("id"), F.xxhash64(text_or_empty(text_col)).alias("print"))
    # a key is one text's, so it is in one group; the smallest key of a group is its component
    groups = simhash_groups(docs.select(F.when(F.col(id_col).isNotNull(), id_and_print).alias("key"), F.col(text_col).alias("text")),
                            "key", "text", **how)
    stays = groups.where("id = component").select("id.id", "id.print").distinct()
    packed = docs.select(whole_row(docs).alias("row"), id_and_print.alias("key")).select("row", "key.*")
    kept = packed.where("id is not null").dropDuplicates(["id", "print"]).join(stays, ["id", "print"], "left_semi")
    return packed.where("id is null").select("row.*").unionByName(kept.select("row.*"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every row of ``documents``."""
    return simhash_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"))
