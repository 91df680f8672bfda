"""Daily totals of a stream, exact under redelivery and rows of any age.

Layout below `path`:

```
rows/activity_date=D/part=b<batch>   what one micro-batch delivered for the day
rows/activity_date=D/part=c<batch>   the day's rows up to that batch, one per identity
totals/activity_date=D               totals per key, one row per key
```

A micro-batch adds one part to each day it touches, reads those days and no
others, keeps the last delivery of every identity and replaces the days' totals.
A replayed batch replaces its own parts with the same rows. A day with
`max_parts` parts is compacted into one `c` part; the parts it holds are deleted
only after it is written, and until then they are rows of the same identities, so
a crash in between changes nothing. Identities are told apart within a day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "activity_date"


@dataclass(frozen=True)
class DailyStore:
    """`identity`: the columns that tell events apart; `key`: what totals are
    kept for; `amount`: the summand of an event; `total`: name of the sum."""

    path: str
    identity: tuple[str, ...]
    key: str
    amount: Column
    total: str
    max_parts: int = 24

    @property
    def _rows(self) -> str:
        return f"{self.path.rstrip('/')}/rows"

    @property
    def _totals(self) -> str:
        return f"{self.path.rstrip('/')}/totals"

    def add(self, batch: DataFrame, batch_id: int) -> list[dt.date]:
        """Take in a micro-batch (with a time `ts`); the days whose totals it
        replaced. Rows without a time belong to no day and are left out."""
        spark = batch.sparkSession
        latest = [F.col(c) for c in ("_ingested_at", "_pubsub_message_id") if c in batch.columns]
        rest = [F.col(c) for c in batch.columns]
        rows = (
            batch.withColumn(DAY, F.to_date("ts")).filter(F.col(DAY).isNotNull())
            .groupBy(DAY, *self.identity)
            .agg(F.max_by(F.struct(F.col(self.key).alias("key"), self.amount.alias("amount")),
                          F.struct(*latest, F.xxhash64(*rest))).alias("last"))
            .select(DAY, *self.identity, "last.key", "last.amount", F.lit(batch_id).cast("long").alias("delivered"),
                    F.lit(f"b{batch_id:09d}").alias("part"))
        )
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, "part").parquet(self._rows)
        written = spark.read.option("basePath", self._rows).schema(rows.schema)
        try:
            mine = written.parquet(f"{self._rows}/{DAY}=*/part=b{batch_id:09d}")
        except Exception as exc:  # an empty batch wrote no part
            if getattr(exc, "getCondition", lambda: "")() != "PATH_NOT_FOUND":
                raise
            return []
        days = sorted(r[0] for r in mine.select(DAY).distinct().collect())  # as many as days
        if not days:
            return []
        (
            self.events(spark, days).groupBy(DAY, F.col("key").alias(self.key)).agg(F.sum("amount").alias(self.total))
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(self._totals)
        )
        self.compact(spark, [d for d in days if len(self._parts(spark, d)) >= self.max_parts])
        return days

    def events(self, spark: SparkSession, days: Iterable[dt.date]) -> DataFrame:
        """(day, identity, key, amount, delivered) of some days, the last delivery
        of each identity; only these days' files are listed and read."""
        paths = [f"{self._rows}/{DAY}={d}" for d in days]
        return (
            spark.read.option("basePath", self._rows).parquet(*paths)
            .groupBy(DAY, *self.identity)
            .agg(F.max_by(F.struct("key", "amount", "delivered"), "delivered").alias("last"))
            .select(DAY, *self.identity, "last.*")
        )

    def totals(self, spark: SparkSession, days: Iterable[dt.date]) -> DataFrame:
        """(key, day, total) of some days; days without events have no rows."""
        return spark.read.parquet(self._totals).filter(F.col(DAY).isin(list(days))).select(self.key, DAY, self.total)

    def compact(self, spark: SparkSession, days: Iterable[dt.date]) -> None:
        """One part each for some days."""
        for day in days:
            parts = self._parts(spark, day)
            newest = max((p[1:] for p in parts), default="")
            if len(parts) < 2:
                continue
            into = f"c{newest}"
            (
                self.events(spark, [day]).withColumn("part", F.lit(into))
                .hint("rebalance")
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY, "part").parquet(self._rows)
            )
            for p in parts:
                if p != into:
                    self._delete(spark, f"{self._rows}/{DAY}={day}/part={p}")

    def _parts(self, spark: SparkSession, day: dt.date) -> list[str]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{self._rows}/{DAY}={day}")
        found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
        return sorted(n[len("part="):] for n in (s.getPath().getName() for s in found) if n.startswith("part="))

    def _delete(self, spark: SparkSession, path: str) -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
