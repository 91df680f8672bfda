"""Registered queries: each detection on the fixture sources of a scale dir.

A registered query returns the detection exactly as the library produces
it, with presentation changes so the result compares across engines:
arrays are rendered as comma-joined text, dates as ISO `yyyy-MM-dd` text
(engines hand dates to pandas as different types), `detected_at` (wall
clock) is left out; `event_date` for the undated tables uses a fixed as-of date.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType

from gatewatch.oracle import AS_OF_DATE, RUN_ID, VARIANTS
from gatewatch.plans.registry import SCORED, TABLES, StoredFrames, build_detections
from gatewatch.sources.fixtures import fixture_sources


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if f.name == "detected_at":
            continue
        if isinstance(f.dataType, ArrayType):
            cols.append(F.array_join(F.col(f.name), ",").alias(f.name))
        elif isinstance(f.dataType, DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def detection(spark: SparkSession, sf_dir: str, table: str, params: dict | None = None) -> DataFrame:
    linked = fixture_sources(spark, sf_dir)
    frames = linked.without_links()
    if table in SCORED:  # these read the linked sources too
        frames = linked = StoredFrames(linked)
    out = build_detections(
        frames, RUN_ID, tables=[table], as_of_date=AS_OF_DATE, with_detected_at=False,
        params={table: params} if params else None, request_frames=linked,
    )[table]
    return comparable(out)


def _detection_query(table: str, params: dict | None = None, name: str | None = None
                     ) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return detection(spark, sf_dir, table, params)

    run.__name__ = name or table
    return run


DETECTION_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    t: _detection_query(t) for t in TABLES
}
# the same rules at lower thresholds, for fixtures where the defaults leave
# only a row or two
DETECTION_QUERIES.update(
    {name: _detection_query(table, params, name) for name, (table, params) in VARIANTS.items()}
)
