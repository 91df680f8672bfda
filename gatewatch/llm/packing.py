"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token pieces of at most ``capacity`` ids (id 0 ends each
document; only longer ones are cut, the remainder comes first). Full pieces are
sequences of their own. The others are dealt by a hash into demes of about
``deme_size`` pieces, one state row each. A deme has several islands, each with
its own population of packings. An individual is a list of bins; a child takes a
slice of one parent's well-filled bins whole, keeps the other parent's bins
without a piece of these, and the displaced pieces are best-fitted in order of
size. Between rounds the elite of each island migrates to the next one of its
deme, by a join. A deme stops once it reaches the lower bound. Then the pieces
of bins that are not well filled are dealt anew, across demes, and packed again.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpointed, table, text_or_empty, with_id
from .tokens import token_ids

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END = (0).to_bytes(4, "little")


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all full but perhaps the first."""
    first = n % capacity or min(n, capacity)
    starts = [0, *range(first, n, capacity)]
    return [(s, (e - s)) for s, e in zip(starts, [*starts[1:], n], strict=True)]


def token_pieces(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
                 tokenizer: str = TOKENIZER, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every document."""
    extra = ", ids array<int>" if with_ids else ""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = token_ids(tokenizer)
        for batch in batches:
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for r, value in enumerate(batch.column(1)):
                raw = encode(value.as_py()) + END
                for p, (s, n) in enumerate(cut_pieces(len(raw) // 4, capacity)):
                    part = raw[4 * s : 4 * (s + n)]
                    row.append(r), piece.append(p), start.append(s), length.append(n), crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int32))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col)).mapInArrow(
        work, with_id(docs, id_col, f"piece int, start long, length long, ids_crc32 long{extra}"))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """No packing has fewer bins: by volume, and by pieces over half a bin."""
    big = lengths[lengths * 2 > capacity]
    small = lengths[lengths * 2 <= capacity]
    left = max(0, int(small.sum()) - int((capacity - big).sum()))
    return len(big) + -(-left // capacity)


def best_fit(bins: list[list[int]], room: list[int], items: list[int], lengths: list[int], capacity: int) -> None:
    """Put each item, in the order given, into the fullest bin that holds it."""
    by_room: dict[int, list[int]] = {}
    mask = 0  # bit r is set if a bin has room r
    for b, r in enumerate(room):
        if r:
            by_room.setdefault(r, []).append(b)
            mask |= 1 << r
    for i in items:
        need = lengths[i]
        fits = mask >> need
        if fits:
            r = need + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                mask &= ~(1 << r)
            bins[b].append(i)
        else:
            b, r = len(bins), capacity
            bins.append([i])
            room.append(0)
        room[b] = r - need
        if room[b]:
            by_room.setdefault(room[b], []).append(b)
            mask |= 1 << room[b]


class Packing:
    """An individual: bins of items and the room left in each."""

    def __init__(self, bins: list[list[int]], room: list[int], capacity: int) -> None:
        self.bins, self.room = bins, room
        self.fitness = (len(bins), -sum((capacity - r) ** 2 for r in room))

    @classmethod
    def of(cls, place: np.ndarray, lengths: list[int], capacity: int) -> Packing:
        """From the bin number of each item."""
        bins: list[list[int]] = [[] for _ in range(int(place.max()) + 1)] if len(place) else []
        for i, b in enumerate(place.tolist()):
            bins[b].append(i)
        return cls(bins, [capacity - sum(lengths[i] for i in b) for b in bins], capacity)

    def places(self, n: int) -> np.ndarray:
        out = np.zeros(n, np.int32)
        for b, items in enumerate(self.bins):
            out[items] = b
        return out


def evolve(lengths: np.ndarray, capacity: int, seed: int, start: list[np.ndarray], generations: int = 5,
           population: int = 4) -> np.ndarray:
    """Bin number of each item after some generations; ``start`` holds packings
    to begin with (elites of this island and of its neighbour)."""
    rng = np.random.default_rng(seed)
    n, sizes = len(lengths), lengths.tolist()
    goal = lower_bound(lengths, capacity)

    def fresh(noise: float) -> Packing:
        order = np.argsort(-lengths * (1 + noise * rng.random(n)), kind="stable").tolist()
        bins: list[list[int]] = []
        room: list[int] = []
        best_fit(bins, room, order, sizes, capacity)
        return Packing(bins, room, capacity)

    def child(a: Packing, b: Packing) -> Packing:
        full = [k for k in rng.permutation(len(b.bins)).tolist() if b.room[k] * 64 <= capacity]
        full = full[: max(1, len(full) // 2)]
        taken = bytearray(n)
        for k in full:
            for i in b.bins[k]:
                taken[i] = 1
        bins, room = [list(b.bins[k]) for k in full], [b.room[k] for k in full]
        displaced = []
        for items, r in zip(a.bins, a.room, strict=True):
            if r * 16 <= capacity and not any(taken[i] for i in items):
                bins.append(list(items))
                room.append(r)
            else:  # holds an injected piece, or is poorly filled
                displaced += [i for i in items if not taken[i]]
        displaced.sort(key=lambda i: -sizes[i])
        best_fit(bins, room, displaced, sizes, capacity)
        return Packing(bins, room, capacity)

    pool = [Packing.of(p, sizes, capacity) for p in start] or [fresh(0.0 if seed % 2 == 0 else 0.02)]
    if pool[0].fitness[0] > goal:
        while len(pool) < population:
            pool.append(fresh(0.05))
        for _ in range(generations):
            pool.sort(key=lambda p: p.fitness)
            if pool[0].fitness[0] <= goal:
                break
            a, b = rng.permutation(len(pool))[:2].tolist()
            pool = [*pool[:population], child(pool[0], pool[b]), child(pool[a], pool[0])]
    return min(pool, key=lambda p: p.fitness).places(n)


def island_round(states: DataFrame, capacity: int, generations: int, seed: int) -> DataFrame:
    """One round on every (deme, island) state; ``migrant`` may be null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                start = [np.array(row[c], np.int64) for c in ("best", "migrant") if row[c] is not None]
                best = evolve(lengths, capacity, seed + 2 * row["deme"] * 1009 + row["island"], start, generations)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["deme"]], pa.int64()), pa.array([row["island"]], pa.int32()),
                    pa.array([row["items"]], pa.list_(pa.int64())), pa.array([row["lengths"]], pa.list_(pa.int32())),
                    pa.array([best.tolist()], pa.list_(pa.int32())), pa.array([int(best.max()) + 1 if len(best) else 0], pa.int32())],
                    names=["deme", "island", "items", "lengths", "best", "n_bins"])

    schema = "deme long, island int, items array<long>, lengths array<int>, best array<int>, n_bins int"
    return states.repartition("deme", "island").mapInArrow(work, schema)


def pack(items: DataFrame, capacity: int, deme_size: int, islands: int, rounds: int, generations: int, seed: int) -> DataFrame:
    """(deme, items, lengths, best) of the best island of each deme.

    ``items`` has a distinct long ``item`` and its ``length`` (1 to capacity)."""
    demes = max(1, -(-items.count() // deme_size))
    dealt = items.groupBy(F.pmod(F.xxhash64(F.lit(seed), "item"), F.lit(demes)).cast("long").alias("deme")).agg(
        F.array_sort(F.collect_list(F.struct(F.col("length").cast("int").alias("length"), "item"))).alias("all"))
    states = dealt.select(
        "deme", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("all.item").alias("items"),
        F.col("all.length").alias("lengths"), F.lit(None).cast("array<int>").alias("best"),
        F.lit(None).cast("array<int>").alias("migrant"))
    for r in range(rounds):
        done = checkpointed(island_round(states, capacity, generations, seed + 7919 * r))
        elite = done.select("deme", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("best").alias("migrant"))
        states = done.join(elite, ["deme", "island"])
    best = done.groupBy("deme").agg(F.min(F.struct("n_bins", "island")).alias("b")).select("deme", F.col("b.island").alias("island"))
    return done.join(best, ["deme", "island"]).select("deme", "items", "lengths", "best")


def placed(states: DataFrame, capacity: int, prefix: int) -> DataFrame:
    """(item, length, sequence_id, offset, room) of every item of the states."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths, place = np.array(row["lengths"], np.int64), np.array(row["best"], np.int64)
                order = np.argsort(place, kind="stable")
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.searchsorted(place[order], place[order])
                used = np.bincount(place, lengths).astype(np.int64)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.array(row["items"], np.int64)[order]), pa.array(lengths[order]),
                    pa.array((((row["deme"] << 24) | place[order]) << 1) | prefix), pa.array(before - before[first]),
                    pa.array(capacity - used[place[order]])], names=["item", "length", "sequence_id", "offset", "room"])

    return states.mapInArrow(work, "item long, length long, sequence_id long, offset long, room long")


def pack_documents(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
                   deme_size: int = 4000, islands: int = 2, rounds: int = 2, generations: int = 5, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset): one row
    per piece. Null and empty texts are one piece of the end id; repeated rows
    are packed each; a null id keeps its pieces; an empty table gives no rows;
    other columns are not read."""
    pieces = token_pieces(docs, capacity, id_col, text_col, tokenizer, with_ids)
    pieces = checkpointed(pieces.withColumn("item", F.monotonically_increasing_id()))
    how = (capacity, deme_size, islands, rounds, generations)
    first = checkpointed(placed(pack(pieces.where(F.col("length") < capacity).select("item", "length"), *how, seed=1), capacity, 0))
    loose = F.col("room") * 100 > capacity
    second = placed(pack(first.where(loose).select("item", "length"), *how, seed=2), capacity, 1)
    places = first.where(~loose).unionByName(second).select("item", "sequence_id", "offset")
    full = pieces.where(F.col("length") == capacity).select("item", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return pieces.join(places.unionByName(full), "item").drop("item")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of every piece of ``documents`` in sequences of 2048 ids."""
    return pack_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
