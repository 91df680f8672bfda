"""Rows of a key in time order, over a stream that delivers them in any order.

State is read by key and time only: new rows are appended to a list without
reading it; when the watermark passes a tick of `tick_seconds` with rows, the list
of that key is read once, the rows before the watermark go through the step in
order, and the others stay. Besides the list a key holds the last `carry` rows
that the step can look back to.

`split_by_time` deals a key's rows by time buckets to different keys, so that a
hot user is spread over tasks as far as its rows are spread over time. A row also
goes to the `carry` buckets after its own, where only the latest ones are held as
what comes before the bucket's first row. That is exact as long as neighbouring
rows further apart than a bucket have nothing to do with each other. A bucket's
state is gone once the watermark passes its end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# time in microseconds, place among rows of equal time and its tie-break
ORDER = ("at", "rank", "id")
Step = Callable[[tuple, list[tuple], tuple], tuple | None]


def in_order(rows: Iterable[tuple]) -> list[tuple]:
    return sorted(rows, key=lambda r: (r[0], r[1], "" if r[2] is None else r[2]))


class OrderedRows(StatefulProcessor):
    """`step(key, before, row) -> output or None` over the rows of a key in order;
    a row is a tuple of the order columns and the payload. `before` are the last
    `carry` rows that `keeps` (all by default), oldest first."""

    def __init__(self, payload: tuple[str, ...], step: Step, output: tuple[str, ...], *, carry: int = 1,
                 keeps: Callable[[tuple], bool] | None = None, tick_seconds: int = 300, bucket_seconds: int | None = None) -> None:
        self.columns, self.step, self.output = (*ORDER, *payload), step, output
        self.carry, self.keeps = carry, keeps
        self.tick, self.bucket = tick_seconds * 1000, bucket_seconds and bucket_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = ", ".join(["at long", "rank int", "id string", *[f"{c} string" for c in self.columns[3:]]])
        self.handle = handle
        self.held = handle.getListState("held", schema)
        self.before = handle.getListState("before", schema)

    def _look_back(self) -> list[tuple]:
        return in_order(map(tuple, self.before.get()))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        own, earlier, ticks = [], [], set()
        for row in rows:
            values = tuple(row[c] for c in self.columns)
            if self.bucket is None or row["own"]:
                own.append(values)
                ticks.add((values[0] // 1000 // self.tick + 1) * self.tick)
            else:
                earlier.append(values)
        if own:
            self.held.appendList(own)
        if earlier:
            latest = in_order([*self._look_back(), *earlier])[-self.carry :]
            self.before.put(latest)
        if self.bucket is not None:
            ticks.add((key[-1] + 1) * self.bucket)
        for t in ticks:
            self.handle.registerTimer(t)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        rows = in_order(map(tuple, self.held.get())) if self.held.exists() else []
        ready = [r for r in rows if r[0] < watermark * 1000]
        over = self.bucket is not None and watermark >= (key[-1] + 1) * self.bucket
        if ready:
            before = self._look_back() if self.before.exists() else []
            for row in ready:
                found = self.step(key, before, row)
                if found is not None:
                    yield Row(**dict(zip(self.output, found, strict=True)))
                if self.keeps is None or self.keeps(row):
                    before = [*before, row][-self.carry :]
            if before:
                self.before.put(before)
            if len(rows) > len(ready):
                self.held.put(rows[len(ready) :])
            else:
                self.held.clear()
        if over and len(rows) == len(ready):
            self.before.clear()

    def close(self) -> None:
        pass


def ordered_columns(ts: str, tie_break: str | Column, rank: Column | None = None) -> list[Column]:
    """The order columns of rows; `ts` is a TIMESTAMP."""
    return [F.unix_micros(F.col(ts)).alias("at"), (F.lit(0) if rank is None else rank).cast("int").alias("rank"),
            (F.col(tie_break) if isinstance(tie_break, str) else tie_break).cast("string").alias("id")]


def split_by_time(rows: DataFrame, bucket_seconds: int, carry: int) -> DataFrame:
    """`rows` with `bucket` and `own`: each row in its own bucket, and as an
    earlier one in the `carry` buckets after it."""
    own = F.floor(F.col("at") / F.lit(bucket_seconds * 1_000_000)).cast("long")
    deals = F.explode(F.transform(F.sequence(F.lit(0), F.lit(carry)), lambda k: F.struct(
        (own + k).alias("bucket"), (k == 0).alias("own"))))
    return rows.withColumn("_deal", deals).select("*", "_deal.bucket", "_deal.own").drop("_deal")


def scan_in_order(rows: DataFrame, keys: list[str], processor: OrderedRows, schema: str) -> DataFrame:
    """The outputs of `processor` over a stream with a watermark, append mode."""
    return rows.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=schema, outputMode="append", timeMode="eventtime")
