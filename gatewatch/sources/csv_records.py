"""CSV records over splits of a file: quoted line breaks without one task per file.

Spark cannot split a CSV file whose fields may hold line breaks, since a split does
not know whether it begins inside quotes. Here the lines are read as text, which
splits, in two passes. The first runs every split from both possible states and
returns the two states it ends in; composed in order of the splits they give every
split the state it begins in. The second joins the lines of a record. A record
that reaches over the end of a split comes as fragments, at most two a split, which
are put together by file.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# One quote character, doubled inside a quoted field (RFC 4180).
QUOTE, COMMA = b'"', b","


def quoted_after(line: bytes, inside: bool) -> bool:
    """Whether a line that begins inside (or outside) quotes ends inside them. A
    quote opens a field at its start only; elsewhere it is a character."""
    at = 0
    while True:
        at = line.find(QUOTE, at)
        if at < 0:
            return inside
        if inside:
            if line[at + 1 : at + 2] == QUOTE:
                at += 1
            else:
                inside = False
        elif at == 0 or line[at - 1 : at] == COMMA:
            inside = True
        at += 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"))


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    """(file, block, lines) of the runs of rows of one split. Take all lines of a
    run before the next."""
    rows = (r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "line")), strict=True))
    row = next(rows, None)
    while row is not None:
        file, block = row[:2]

        def run() -> Iterator[bytes]:
            nonlocal row
            while row is not None and row[:2] == (file, block):  # noqa: B023
                line, row = row[2], next(rows, None)
                yield line

        yield file, block, run()


def start_states(spark: SparkSession, path: str) -> tuple[dict[tuple[str, int], bool], bool]:
    """Whether each split of the files begins inside quotes, as many entries as
    splits; and whether any split ends inside them."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, lines in _splits(batches):
            outside, inside = False, True
            for line in lines:
                if QUOTE in line:
                    outside, inside = quoted_after(line, outside), quoted_after(line, inside)
            yield pa.RecordBatch.from_pylist([{"file": file, "block": block, "outside": outside, "inside": inside}], schema=kind)

    kind = pa.schema([("file", pa.string()), ("block", pa.int64()), ("outside", pa.bool_()), ("inside", pa.bool_())])
    found = _lines(spark, path).mapInArrow(work, "file string, block long, outside boolean, inside boolean").collect()
    out: dict[tuple[str, int], bool] = {}
    state, last, any_open = False, None, False
    for r in sorted(found, key=lambda r: (r.file, r.block)):
        if r.file != last:
            state, last = False, r.file
        out[r.file, r.block] = state
        state = r.inside if state else r.outside
        any_open |= state
    return out, any_open


def _parts(lines: DataFrame, states: dict[tuple[str, int], bool], fragments: bool) -> DataFrame:
    """(file, block, part, first, text): whole records (part null), or instead the
    fragments: part 0 goes on from the split before, part 1 begins a record. `first`
    is the first record of a file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for file, block, lines in _splits(batches):
            if (file, block) not in states:
                raise ValueError(f"{file} was split otherwise when its quotes were counted")
            inside, held, part, first = states[file, block], [], None, block == 0
            if inside:
                part = 0
            for line in lines:
                held.append(line)
                inside = quoted_after(line, inside)
                if not inside:
                    if (part is None) != fragments:
                        out.append({"file": file, "block": block, "part": part, "first": first, "text": b"\n".join(held)})
                    held, part, first = [], None, False
                if len(out) >= 5000:
                    yield pa.RecordBatch.from_pylist(out, schema=kind)
                    out = []
            if held and fragments:
                out.append({"file": file, "block": block, "part": 1 if part is None else part, "first": first, "text": b"\n".join(held)})
        yield pa.RecordBatch.from_pylist(out, schema=kind)

    kind = pa.schema([("file", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("first", pa.bool_()), ("text", pa.binary())])
    return lines.mapInArrow(work, "file string, block long, part int, first boolean, text binary")


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, first, record): the records of one or several CSV files, as they
    stand there without their line end; empty lines are left out. The record of a
    field that is never closed ends with the file."""
    # both passes must split alike, also if executors come and go in between
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    states, any_open = start_states(spark, path)
    lines = _lines(spark, path)
    whole = _parts(lines, states, fragments=False).select("file", "first", F.col("text").cast("string").alias("record"))
    if not any_open:
        return _without_line_end(whole)
    pieces = _parts(lines, states, fragments=True)
    order = Window.partitionBy("file").orderBy("block", "part")
    joined = (
        pieces.withColumn("n", F.sum(F.col("part")).over(order)).groupBy("file", "n")
        .agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("block", "part", F.col("text").cast("string").alias("text")))).alias("all"))
        .select("file", "first", F.array_join(F.transform("all", lambda p: p.text), "\n").alias("record"))
    )
    return _without_line_end(whole.unionByName(joined))


def _without_line_end(records: DataFrame) -> DataFrame:
    return records.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter(F.col("record") != "")
