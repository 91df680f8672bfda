"""Helpers shared by the text operators: tables, checkpoints, Arrow text
columns, vectorised words and their hashes."""

from __future__ import annotations

import sys
import tempfile
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Odd multiplier of the rolling hashes and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INV = pow(BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back, so that a
    lost executor costs a re-read and not a recomputation.

    The folder is ``spark.checkpoint.dir`` of the session. Where it is unset, a
    temporary folder is taken on a local master only."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="gatewatch-checkpoint-"))
    return df.checkpoint()


def worker_cache() -> dict:
    """A dict that lives as long as the Python process. Functions that are
    shipped by value have new globals in each task; this outlives them."""
    return sys.modules.setdefault("_gatewatch_worker", types.ModuleType("_gatewatch_worker")).__dict__


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).alias(name)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, to travel beside a text under one name."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def with_id(df: DataFrame, id_col: str, rest: str) -> StructType:
    """Result schema: ``id`` of the type of a column, and the columns of a DDL text."""
    return StructType([StructField("id", df.schema[id_col].dataType), *StructType.fromDDL(rest).fields])


def utf8_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the row offsets into them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def byte_chunks(at: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    lo, rows = 0, len(at) - 1
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + size, side="right")) - 1)
        yield lo, min(hi, rows)
        lo = min(hi, rows)


def spaced(raw: np.ndarray, at: np.ndarray, lo: int, hi: int, fill: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of rows ``lo`` to ``hi`` with one ``fill`` byte after each row,
    and the start of each row in them."""
    length = np.diff(at[lo : hi + 1])
    start = np.zeros(hi - lo + 1, np.int64)
    np.cumsum(length + 1, out=start[1:])
    out = np.full(start[-1], fill, np.uint8)
    keep = np.ones(start[-1], bool)
    keep[start[1:] - 1] = False
    out[keep] = raw[at[lo] : at[hi]]
    return out, start


def word_table(pattern_is_word: Callable[[int], bool]) -> np.ndarray:
    """256 bytes: the byte with A-Z lower-cased where it belongs to a word, else 0."""
    return np.array([(b + 32 if 65 <= b <= 90 else b) if pattern_is_word(b + 32 if 65 <= b <= 90 else b) else 0
                     for b in range(256)], np.uint8)


# Words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z.
ALNUM = word_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def alnum_words(text: bytes) -> list[bytes]:
    """The lower-cased words of one UTF-8 text, in order."""
    return text.translate(ALNUM.tobytes().replace(b"\x00", b" ")).split()


def spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.ones(max(n, 1), np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out[:n]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal spans have equal hashes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=total[1:])
    back = powers(BASE_INV, len(data) + 1)
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` consecutive values."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + words[i : len(words) - n + 1 + i]
    return mix(out)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph, by alternating large-star
    and small-star steps until nothing changes.

    ``edges`` has long columns ``a`` and ``b``; nulls and loops are left out.
    Returns one row (node, root) per node with an edge; root is the smallest
    node of its component. Each step is grouped minimums (combined before the
    shuffle) joined back to the edges, so a node with many edges is never one
    task's group. Rounds grow with the logarithm of the component size."""
    clean = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = checkpointed(clean)
    before = None
    while True:
        stamp = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if stamp[0] == 0 or stamp == before:
            return (now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
                    .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()))
        before = stamp
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, both.a == low.u).where("b > a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        small_low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(small_low, large.a == small_low.u)
                 .select(F.explode(F.array(
                     F.struct(F.col("b").alias("x"), F.col("m").alias("y")),
                     F.struct(F.col("a").alias("x"), F.col("m").alias("y")))).alias("e"))
                 .select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a <> b").distinct())
        now = checkpointed(small)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index reachable from each of ``n`` indices over links (a, b)."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jump = label[label]
            if np.array_equal(jump, label):
                break
            label = jump
        apart = label[a] != label[b]
        a, b = a[apart], b[apart]
    return label
