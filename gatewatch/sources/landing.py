"""Landing decoded source rows as Parquet, idempotently.

Layout: `<root>/<source>/run_id=<run>/part-*.parquet`. Each write dedups
the batch by identity (latest delivery wins) and appends; because the load
side (`loader.load_source`) dedups again by identity, a batch that is landed
twice (at-least-once delivery, a retried task, a replayed stream batch)
changes nothing downstream.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewatch.sources.loader import dedup_source, source_path

def land_source(df: DataFrame, root: str, source: str) -> None:
    """Dedup one source batch by identity (last delivery wins) and append it
    under its run. The rows are rebalanced by run before the write, so file
    sizes follow the advisory partition size and not the number of tasks."""
    (
        dedup_source(df, source)
        .drop("_delivery")
        .withColumn("run_id", F.col("_pipeline_run_id"))
        .hint("rebalance", F.col("run_id"))
        .write.mode("append")
        .partitionBy("run_id")
        .parquet(source_path(root, source))
    )


def land(by_source: Mapping[str, DataFrame], root: str) -> list[str]:
    """Land every source in sorted order; returns the paths written to."""
    written = []
    for source in sorted(by_source):
        land_source(by_source[source], root, source)
        written.append(source_path(root, source))
    return written
