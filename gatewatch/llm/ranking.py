"""Ranked lexical search by presence masks.

Every item is a set of terms. Its documents are grouped by presence mask, the
set of its terms that a document holds, one bit per term. All documents of a
mask share an upper bound of their score: that of a document with the group's
least length factor and, for every term of the mask, the term's largest count.
Masks are taken by descending bound, their documents are scored exactly, and the
item is finished when the bound of the next mask is below the last place so far.
A mask whose bound equals it is still scored, since a smaller id wins a tie.

Documents are read twice: once to count documents, terms and the document
frequency of the items' terms, once to score. A task goes through its documents
in blocks of about ``block_bytes`` of text, keeps the best rows of every item
from block to block and hands out at most ``top`` rows per item; the final ranks
are a window over those. Terms are told apart by 64-bit hashes.

The items are the query set. They are sent to the tasks in blocks of at most
``item_bytes`` of terms (an item is never cut), as arrays of hashes and numbers;
with several blocks the documents are read twice per block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import ALNUM, alnum_words, byte_chunks, checkpointed, spaced, span_hashes, spans, table, text_or_empty, utf8_rows, with_id

SCALE, LINEAR, LENGTH = 1_000_000_000, 1000, 20  # fixed values of the score
BASE_LENGTH, SLOPE = 50, 50
WORD_BITS = 62  # bits of a mask in one number


@dataclass
class Items:
    """The items of a block: sorted term hashes, and per item the numbers of its terms."""

    terms: np.ndarray
    start: np.ndarray
    number: np.ndarray

    @classmethod
    def of(cls, hashes: list[list[int]]) -> Items:
        flat = np.array([h for own in hashes for h in own], np.int64).view(np.uint64)
        terms, number = np.unique(flat, return_inverse=True)
        return cls(terms, np.concatenate(([0], np.cumsum([len(h) for h in hashes]))), number.astype(np.int32))


def term_hashes(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, terms): the distinct term hashes of every item, over all its rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1).cast(pa.binary()):
                words = sorted(set(alnum_words(value.as_py())))
                data = np.frombuffer(b"".join(words), np.uint8)
                end = np.cumsum([len(w) for w in words], dtype=np.int64)
                out.append(span_hashes(data, end - [len(w) for w in words], end).view(np.int64) if words else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], names=["item", "terms"])

    schema = StructType([StructField("item", items.schema[item_col].dataType), *StructType.fromDDL("terms array<long>").fields])
    rows = items.select(F.col(item_col).alias("item"), text_or_empty(text_col)).mapInArrow(work, schema)
    return rows.select("item", F.explode("terms").alias("t")).groupBy("item").agg(F.array_sort(F.collect_set("t")).alias("terms"))


class Postings:
    """The item terms of a block of documents: per term its rows and counts."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, lo: int, hi: int, terms: np.ndarray, seen: np.ndarray) -> None:
        data, row_at = spaced(raw, at, lo, hi)
        low = ALNUM[data]
        first, last = spans(low != 0)
        row = np.searchsorted(row_at, first, side="right") - 1
        self.size = np.bincount(row, minlength=hi - lo)
        hashes = span_hashes(low, first, last)
        some = seen[hashes >> np.uint64(48)]
        hashes, row = hashes[some], row[some]
        number = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
        own = terms[number] == hashes if len(terms) else np.zeros(0, bool)
        key, count = np.unique(number[own] * (hi - lo) + row[own], return_counts=True)
        self.row, self.count = key % (hi - lo), count
        self.start = np.searchsorted(key, np.arange(len(terms) + 1) * (hi - lo))

    def frequency(self) -> np.ndarray:
        return np.diff(self.start)


def presence(terms: np.ndarray) -> np.ndarray:
    """Which upper 16 bits occur among the term hashes."""
    seen = np.zeros(1 << 16, bool)
    seen[terms >> np.uint64(48)] = True
    return seen


def score(weight: np.ndarray, count: np.ndarray, length: np.ndarray) -> np.ndarray:
    return weight * ((SCALE * count) // (LINEAR * count + LENGTH * length))


def candidates(post: Postings, own: np.ndarray, weight: np.ndarray, length: np.ndarray, most: np.ndarray, top: int,
               least: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block and their scores for one item: all that can be among its
    ``top`` best (ties of the last place included), none below ``least``. ``own``
    are the item's term numbers, ``most`` the largest count of each term."""
    own = own[post.start[own + 1] > post.start[own]]
    if not len(own):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    masks = np.zeros((-(-len(own) // WORD_BITS), len(post.size)), np.int64)
    for k, t in enumerate(own):
        masks[k // WORD_BITS, post.row[post.start[t] : post.start[t + 1]]] |= 1 << (k % WORD_BITS)
    rows = np.flatnonzero(masks.any(0))
    if len(masks) == 1:
        kinds, group = np.unique(masks[0, rows], return_inverse=True)
        kinds = kinds[None, :]
    else:
        kinds, group = np.unique(masks[:, rows], axis=1, return_inverse=True)
        group = group.ravel()
    shortest = np.full(kinds.shape[1], np.iinfo(np.int64).max)
    np.minimum.at(shortest, group, length[rows])
    bound = np.zeros(kinds.shape[1], np.int64)
    for k, t in enumerate(own):
        held = np.flatnonzero(kinds[k // WORD_BITS] >> (k % WORD_BITS) & 1)
        bound[held] += score(weight[t], most[t], shortest[held])
    by = np.argsort(-bound, kind="stable")
    members = np.argsort(group, kind="stable")
    begin = np.concatenate(([0], np.cumsum(np.bincount(group, minlength=len(bound)))))
    sizes = np.diff(begin)[by]
    done, found_rows, found = 0, [], []
    while done < len(by) and bound[by[done]] >= max(least, 1):
        # as many masks as hold `top` documents, then as many again
        to = done + int(np.searchsorted(np.cumsum(sizes[done:]), max(top, sum(map(len, found))))) + 1
        to = min(to, done + int(np.searchsorted(-bound[by[done:]], -max(least, 1), side="right")))
        at = np.sort(rows[np.concatenate([members[begin[g] : begin[g + 1]] for g in by[done:to]])])
        total = np.zeros(len(at), np.int64)
        for t in own:
            a, b = post.start[t], post.start[t + 1]
            place = np.minimum(np.searchsorted(post.row[a:b], at), b - a - 1)
            hit = post.row[a + place] == at
            total[hit] += score(weight[t], post.count[a + place[hit]], length[at[hit]])
        found_rows.append(at)
        found.append(total)
        done = to
        every = np.concatenate(found)
        if len(every) >= top:
            least = max(least, int(np.partition(every, len(every) - top)[len(every) - top]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, total = np.concatenate(found_rows), np.concatenate(found)
    keep = total >= max(least, 1)
    return at[keep], total[keep]


def _counts(docs: DataFrame, items: Items, block_bytes: int) -> dict[int, int]:
    """Document frequency by term number; -1: documents with terms, -2: all terms."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = presence(items.terms)
        total, n, words = np.zeros(len(items.terms), np.int64), 0, 0
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            for lo, hi in byte_chunks(at, block_bytes):
                post = Postings(raw, at, lo, hi, items.terms, seen)
                total += post.frequency()
                n += int((post.size > 0).sum())
                words += int(post.size.sum())
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate((held, [-1, -2]))), pa.array(np.concatenate((total[held], [n, words])))],
                                         names=["term", "n"])

    rows = docs.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {r.term: r.n for r in rows.collect()}  # as many rows as the block has terms


def _best(docs: DataFrame, items: Items, weight: np.ndarray, n: int, words: int, top: int, block_bytes: int) -> DataFrame:
    """(number, id, score): of every task the best rows of every item."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = presence(items.terms)
        kept: list[list[tuple]] = [[] for _ in range(len(items.start) - 1)]
        ids_type = None
        for batch in batches:
            raw, at = utf8_rows(batch.column("text"))
            ids_type = batch.column("id").type
            for lo, hi in byte_chunks(at, block_bytes):
                post = Postings(raw, at, lo, hi, items.terms, seen)
                if not len(post.row):
                    continue
                length = BASE_LENGTH + SLOPE * post.size * n // words
                most = np.zeros(len(items.terms), np.int64)
                some = np.flatnonzero(post.frequency())
                most[some] = np.maximum.reduceat(post.count, post.start[some])
                ids = batch.column("id").slice(lo, hi - lo)
                for k, held in enumerate(kept):
                    least = -held[top - 1][0] if len(held) >= top else 1
                    rows, scores = candidates(post, items.number[items.start[k] : items.start[k + 1]], weight, length, most, top, least)
                    if len(rows):
                        names = ids.take(pa.array(rows)).to_pylist()
                        held += [(-s, i is None, i) for s, i in zip(scores.tolist(), names, strict=True)]
                        held.sort(key=lambda r: r if not r[1] else (r[0], True))
                        del held[top:]
        number = [k for k, held in enumerate(kept) for _ in held]
        if number:
            yield pa.RecordBatch.from_arrays([
                pa.array(number, pa.int32()), pa.array([i for held in kept for _, _, i in held], ids_type),
                pa.array([-s for held in kept for s, _, _ in held], pa.int64())], names=["number", "id", "score"])

    id_field = with_id(docs, "id", "score long").fields
    return docs.mapInArrow(work, StructType([*StructType.fromDDL("number int").fields, *id_field]))


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", item_bytes: int = 4 << 20,
                  block_bytes: int = 8 << 20) -> DataFrame:
    """(item, rank, id, score): the ``top`` best rows of ``docs`` per item with a
    score above 0, equal scores by ascending id.

    Null and empty texts have no terms: such documents are not counted, such
    items find nothing. Rows of one item id are one item, and repeated terms
    count once. Repeated documents are ranked each; a null id comes after the
    others of its score. Empty tables give no rows. Other columns are not read."""
    wanted = checkpointed(term_hashes(items, item_col, item_text_col))
    size = wanted.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-8 * size // item_bytes))
    docs = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    out = docs.sparkSession.createDataFrame([], StructType([
        wanted.schema["item"], *with_id(docs, "id", "score long").fields]))
    for b in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).collect()  # at most about item_bytes
        if not rows:
            continue
        block = Items.of([r.terms for r in rows])
        count = _counts(docs, block, block_bytes)
        n, words = count.get(-1, 0), count.get(-2, 0)
        weight = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * count.get(t, 0) + 1))) for t in range(len(block.terms))], np.int64)
        names = docs.sparkSession.createDataFrame(
            [(k, r.item) for k, r in enumerate(rows)], StructType([*StructType.fromDDL("number int").fields, wanted.schema["item"]]))
        best = _best(docs, block, weight, n, words, top, block_bytes)
        out = out.unionByName(best.join(F.broadcast(names), "number").select("item", "id", "score"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return out.select("item", F.row_number().over(order).alias("rank"), "id", "score").where(F.col("rank") <= top)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best rows of ``documents`` for every ``benchmark`` item."""
    found = ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


OP13_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), totals AS (
    SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM words WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), held AS (
    SELECT doc_id, n, term, count(*) AS tf
    FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM words) WHERE term IN (SELECT term FROM wanted)
    GROUP BY doc_id, n, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * t.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM held, totals t GROUP BY term, t.n
), parts AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * held.n * t.n) // t.l))) AS s
    FROM held JOIN weights USING (term), totals t
), scores AS (
    SELECT item_id, doc_id, CAST(sum(s) AS BIGINT) AS score FROM wanted JOIN parts USING (term) GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""
