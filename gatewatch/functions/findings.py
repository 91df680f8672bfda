"""Finding metadata (detection name, deterministic id, event date, run id)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.constants import FINDING_ID_SEPARATOR

METADATA_COLUMNS = ("detection_name", "finding_id", "event_date", "pipeline_run_id", "detected_at")


def finding_id(detection_name: str, identity: list[Column]) -> Column:
    """sha2-256 of 'name||id1||id2...'; a null identity value hashes as ''."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in identity]
    return F.sha2(F.concat_ws(FINDING_ID_SEPARATOR, F.lit(detection_name), *parts), 256)


def as_findings(
    df: DataFrame,
    detection_name: str,
    identity: tuple[str, ...],
    event_column: str | None,
    run_id: str,
    *,
    as_of_date: str | _dt.date | None = None,
    event_date_is_date: bool = False,
    with_detected_at: bool = True,
) -> DataFrame:
    """Append the five metadata columns in one projection.

    Identity columns missing from the frame are skipped. `event_date` is the
    date of `event_column`; without one it is `as_of_date` (fixed, for
    reproducible runs) or the current date. `detected_at` can be left out
    for comparisons between runs.
    """
    present = [F.col(c) for c in identity if c in df.columns]
    if event_column and event_column in df.columns:
        ev = F.col(event_column)
        event_date = ev if event_date_is_date else F.to_date(ev)
    elif as_of_date is not None:
        event_date = F.lit(str(as_of_date)).cast("date")
    else:
        event_date = F.current_date()
    cols = {
        "detection_name": F.lit(detection_name),
        "finding_id": finding_id(detection_name, present),
        "event_date": event_date,
        "pipeline_run_id": F.lit(run_id),
    }
    if with_detected_at:
        cols["detected_at"] = F.current_timestamp()
    return df.withColumns(cols)
