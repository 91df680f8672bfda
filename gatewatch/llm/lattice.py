"""Embedding near-duplicates by E8 lattice hashing.

In each of several tables a random orthonormal projection takes a unit vector to
8 dimensions, where it is scaled and decoded to the nearest point of the E8
lattice, its cell. Besides the own cell a vector probes the ``probes`` lattice
neighbours nearest to it. Two vectors are candidates if one's cell is the
other's cell or among its probes; candidates are verified by their cosine in
double precision, so no link is false. The scale grows with the eighth root of
the number of vectors, which keeps the expected cell size; the number of tables
is taken so that a pair exactly at the threshold is found with the probability
``recall`` (worked out on random pairs, by the given scale). The scale stops
growing where a table would find fewer than ``LEAST`` of such pairs (beyond some
1e8 vectors); then cells grow instead, and no link is given up.

Equal vectors are collapsed first. A linked pair counts in the first table, and
there in one cell, where its two vectors meet; so counts add up and no pairs are
collected. A cell with over ``max_cell`` entries is cut into chunks, and each
pair of chunks is a unit of work of its own.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, checkpointed, components, forest, mix, table, worker_cache


# The least chance of a table to find a pair at the threshold.
LEAST = 0.01


def shortest_vectors() -> np.ndarray:
    """The 240 neighbours of the origin in E8: two entries of size one, or all
    entries of size one half with an even number of minus signs."""
    out = [np.array(v) for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
    out += [np.array(v) / 2 for v in itertools.product((1, -1), repeat=8) if np.prod(v) == 1]
    return np.array(out, float)


def decode_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the better of D8 and D8 shifted by 1/2."""

    def decode_d8(y: np.ndarray) -> np.ndarray:
        near = np.rint(y)
        error = y - near
        odd = np.flatnonzero(near.sum(1) % 2)
        worst = np.abs(error[odd]).argmax(1)
        near[odd, worst] += np.where(error[odd, worst] >= 0, 1, -1)
        return near

    whole, half = decode_d8(x), decode_d8(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1))[:, None], whole, half)


def projections(dim: int, tables: int, seed: int = 17) -> np.ndarray:
    """(tables, dim, 8) with orthonormal columns (padded where dim is under 8);
    made once in a worker."""
    made = worker_cache().setdefault("projections", {})
    if (dim, tables, seed) not in made:
        made[dim, tables, seed] = _projections(dim, tables, seed)
    return made[dim, tables, seed]


def _projections(dim: int, tables: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed + dim)
    return np.stack([np.linalg.qr(rng.standard_normal((max(dim, 8), 8)))[0][:dim] for _ in range(tables)])


def cell_keys(unit: np.ndarray, planes: np.ndarray, scale: float, probes: int) -> np.ndarray:
    """(rows, tables, 1 + probes) keys of cells, the own cell first."""
    around = shortest_vectors()
    out = np.zeros((len(unit), len(planes), 1 + probes), np.uint64)
    for t, plane in enumerate(planes):
        at = scale * math.sqrt(unit.shape[1] / 64) * (unit @ plane)
        home = decode_e8(at)
        toward = (at - home) @ around.T
        near = np.argpartition(-toward, probes, axis=1)[:, :probes] if probes else np.zeros((len(unit), 0), int)
        cells = np.concatenate([home[:, None, :], home[:, None, :] + around[near]], 1)
        key = np.full(cells.shape[:2], np.uint64(1 + t * 1000 + unit.shape[1] * 1_000_000), np.uint64)
        for i in range(8):
            key = key * np.uint64(BASE) + np.rint(2 * cells[:, :, i]).astype(np.int64).view(np.uint64)
        out[:, t] = mix(key)
    return out


def meet(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(pairs, tables): whether the rows of keys ``a`` and ``b`` meet in a table."""
    return (a == b[:, :, :1]).any(2) | (b == a[:, :, :1]).any(2)


def parameters(n: int, threshold: float, probes: int, recall: float, dim: int = 64, base: int = 50_000) -> tuple[float, int]:
    """Scale and number of tables for ``n`` vectors."""
    scale = 5.0 * math.sqrt(0.1 / max(1 - threshold, 1e-6)) * max(n / base, 1.0) ** 0.125
    rng = np.random.default_rng(23)
    x, y = rng.standard_normal((2, 3000, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (y * x).sum(1)[:, None] * x
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * y / np.linalg.norm(y, axis=1)[:, None]
    planes = projections(dim, 32, seed=29)

    def chance(scale: float) -> float:
        """Over as many tables as it takes to see some 300 pairs found."""
        seen = 0.0
        for k in range(len(planes)):
            own = planes[k : k + 1]
            seen += float(meet(cell_keys(x, own, scale, probes), cell_keys(y, own, scale, probes)).mean())
            if seen * len(x) >= 300:
                break
        return seen / (k + 1)

    while (found := chance(scale)) < LEAST:
        scale *= 0.95
    return scale, max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(found, 0.99))))


def unit_rows(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Float64 unit vectors of a list column of one length; the row numbers."""
    lists = lists.cast(pa.large_list(pa.float64()))
    v = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)
    big = np.abs(v).max(1, keepdims=True)
    v = v / big
    return v / np.linalg.norm(v, axis=1)[:, None]


def by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) for each vector length of a list column."""
    sizes = np.asarray(lists.value_lengths())
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, unit_rows(lists.take(pa.array(rows)))


def cell_links(entries: DataFrame, threshold: float, scale: float, tables: int, probes: int) -> DataFrame:
    """(a, n, b): counts n of vectors newly linked with a, or links a - b.

    ``entries``: unit (of work), chunks i and j of the unit, own chunk, home
    (whether the key is the own cell), key, id, copies and the vector."""

    def solve(rows: pa.RecordBatch) -> tuple[np.ndarray, ...] | None:
        home = rows.column("home").to_numpy(zero_copy_only=False)
        if not home.any() or rows.num_rows < 2:
            return None
        (_, unit), *_ = by_length(rows.column("embedding"))  # a key belongs to one length
        ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
        chunk, i, j = rows.column("chunk").to_numpy(), rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        key = np.uint64(rows.column("key")[0].as_py() % (1 << 64))
        mine = np.flatnonzero(chunk == i)
        jobs = [(mine, np.flatnonzero((chunk == j) & home))]
        if i != j:
            jobs.append((np.flatnonzero((chunk == j) & ~home), mine[home[mine]]))
        left, right = [], []
        for a, b in jobs:
            for lo in range(0, len(a), 512):
                x, y = np.nonzero(unit[a[lo : lo + 512]] @ unit[b].T >= threshold)
                x, y = a[lo : lo + 512][x], b[y]
                keep = np.where(home[x], (ids[x] < ids[y]) if i == j else ids[x] != ids[y], ids[x] != ids[y])
                left.append(x[keep])
                right.append(y[keep])
        x, y = np.concatenate(left), np.concatenate(right)
        if not len(x):
            return None
        used, back = np.unique(np.concatenate([x, y]), return_inverse=True)
        planes = projections(unit.shape[1], tables)
        keys = cell_keys(unit[used], planes, scale, probes)
        now = int(np.flatnonzero((keys[back[0]] == key).any(1))[0])  # the table of this key
        keep = np.zeros(len(x), bool)
        for lo in range(0, len(x), 100_000):
            p, q = keys[back[: len(x)][lo : lo + 100_000]], keys[back[len(x) :][lo : lo + 100_000]]
            before = meet(p[:, :now], q[:, :now]).any(1)
            # a probe of y's cell that y's probes answer is counted at the smaller id's cell
            answered = (q[:, now, 1:] == p[:, now, :1]).any(1) & ~home[x[lo : lo + 100_000]]
            keep[lo : lo + 100_000] = ~before & ~(answered & (ids[x[lo : lo + 100_000]] < ids[y[lo : lo + 100_000]]))
        return ids, copies, x, y, keep

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def flush(rows: pa.Table) -> pa.RecordBatch:
            batch = rows.combine_chunks().to_batches()[0]
            name = batch.column("unit").dictionary_encode().indices.to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(name)) + 1).tolist(), len(name)]
            home = np.concatenate(([0], np.cumsum(batch.column("home").to_numpy(zero_copy_only=False))))
            one, n, other = [], [], []
            for lo, hi in itertools.pairwise(cut):
                if hi - lo < 2 or home[hi] == home[lo]:
                    continue
                found = solve(batch.slice(lo, hi - lo))
                if found is None:
                    continue
                ids, copies, x, y, keep = found
                count = np.bincount(x[keep], copies[y[keep]], len(ids)) + np.bincount(y[keep], copies[x[keep]], len(ids))
                some = np.flatnonzero(count)
                one += ids[some].tolist()
                n += count[some].astype(np.int64).tolist()
                other += [None] * len(some)
                root = forest(len(ids), x, y)
                linked = np.flatnonzero(root != np.arange(len(ids)))
                one += ids[linked].tolist()
                n += [None] * len(linked)
                other += ids[root[linked]].tolist()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (one, n, other)], names=["a", "n", "b"])

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 20_000:
                continue
            rows = pa.Table.from_batches(held)
            names = rows.column("unit").combine_chunks()
            end = names.index(names[len(names) - 1]).as_py()  # the last unit may go on
            if end:
                yield flush(rows.slice(0, end))
            held, size = rows.slice(end).to_batches(), len(rows) - end
        if size:
            yield flush(pa.Table.from_batches(held))

    return entries.repartition("unit").sortWithinPartitions("unit").mapInArrow(work, "a long, n long, b long")


def embedding_groups(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id", vec_col: str = "embedding",
                     probes: int = 4, recall: float = 0.99, max_cell: int = 4096) -> DataFrame:
    """(id, n_links, component): one row per row of ``vectors``.

    n_links counts the other rows linked directly, component is the smallest id
    reachable. Vectors that are null, empty, zero or hold a null or non-finite
    entry link with nothing, nor do rows with a null id; vectors of different
    lengths never link. Repeated rows are copies of each other. Other columns
    are not read."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("embedding"))
    fine = F.expr("""id is not null and embedding is not null and size(embedding) > 0
        and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))
        and exists(embedding, x -> x <> 0)""")
    rows = rows.withColumn("fine", F.coalesce(fine, F.lit(False)))
    classes = checkpointed(rows.where("fine").groupBy("embedding").agg(F.min("id").alias("id"), F.count("*").alias("copies")))
    scale, tables = parameters(classes.count(), threshold, probes, recall)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                for own, unit in by_length(part.column("embedding")):
                    keys = cell_keys(unit, projections(unit.shape[1], tables), scale, probes)
                    row = own.repeat(keys[0].size)
                    taken = part.take(pa.array(row))
                    home = np.tile(np.arange(1 + probes) == 0, tables * len(own))
                    yield pa.RecordBatch.from_arrays(
                        [taken.column("embedding"), taken.column("id"), taken.column("copies"),
                         pa.array(keys.ravel().view(np.int64)), pa.array(home)], names=["embedding", "id", "copies", "key", "home"])

    schema = f"embedding {classes.schema['embedding'].dataType.simpleString()}, id long, copies long, key long, home boolean"
    entries = classes.select("embedding", "id", "copies").mapInArrow(keyed, schema)
    hot = checkpointed(entries.groupBy("key").count().where(F.col("count") > max_cell))
    plain = entries.select(F.col("key").cast("string").alias("unit"), F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("chunk"), "*")
    if not hot.isEmpty():
        marked = entries.join(hot.select("key", F.ceil(F.col("count") / max_cell).cast("int").alias("cut")), "key", "left")
        marked = marked.withColumn("cut", F.coalesce("cut", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("cut")).cast("int"))
        other = F.explode(F.expr("sequence(0, cut - 1)"))
        plain = marked.withColumn("other", other).select(
            "*", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j")).select(
            F.concat_ws(":", "key", "i", "j").alias("unit"), "i", "j", "chunk", "embedding", "id", "copies", "key", "home")
    found = checkpointed(cell_links(plain, threshold, scale, tables, probes))
    counts = found.where("n is not null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "id")
    solved = reduce(lambda x, y: x.join(y, "id", "left"), [classes, counts, roots]).select(
        F.col("embedding").alias("vector"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "id").alias("component"))
    linked = rows.where("fine").join(solved, rows.embedding == solved.vector).select("id", "n_links", "component")
    alone = rows.where(~F.col("fine")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone)


def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every row of ``embeddings``."""
    return embedding_groups(table(spark, sf_dir, "embeddings")).select(
        F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))
