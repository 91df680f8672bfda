"""Batch run: load sources, guard, build the requested tables, write, count.

Each table is computed once: the row count rides along with the write as an
`Observation` instead of a separate `count()` pass. Tables that feed other
tables (weighted findings -> risk_scores -> cleanest_users) are consumed
from what was written (or, for inputs not requested as outputs, from a
reliable checkpoint in the cluster's checkpoint folder), so their lineage is
never recomputed and a lost executor only costs a re-read.
"""

from __future__ import annotations

import datetime as _dt
import logging
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gatewatch.functions.columns import safe_identifier_text
from gatewatch.plans.registry import SPECS, build_detections, select_tables
from gatewatch.session import apply_engine_conf, ensure_checkpoint_dir
from gatewatch.sources.contracts import ACTIVITY_SOURCES, RULE_COLUMNS, SOURCE_SCHEMAS
from gatewatch.sources.loader import load_source, scan_source
from gatewatch.sources.sinks import FILE_FORMATS, write_findings

LOG = logging.getLogger("gatewatch.runner")


def validate_identifier(value: str, label: str) -> str:
    """`value`, if identifier normalisation leaves it as it is."""
    safe = safe_identifier_text(value)
    if value != safe:
        raise ValueError(f"{label} {value!r} is not an identifier; {safe!r} would be")
    return value


def load_sources(spark: SparkSession, input_root: str) -> dict[str, DataFrame]:
    """Deduplicated, typed sources narrowed to the columns the rules read."""
    return {s: load_source(spark, input_root, s).select(*RULE_COLUMNS[s]) for s in SOURCE_SCHEMAS}


def guard_activity(frames: Mapping[str, DataFrame]) -> None:
    """Stop before outputs are replaced if no activity source has a row. Give it
    the raw scans: one row of one file is enough to pass."""
    empty = [s for s in ACTIVITY_SOURCES if frames[s].isEmpty()]
    if len(empty) == len(ACTIVITY_SOURCES):
        raise RuntimeError(f"nothing landed for {', '.join(empty)}: the output tables stay as they are")


def _consumers() -> set[str]:
    """Tables that other tables read."""
    return {s.table for s in SPECS.values() if s.factor} | {"risk_scores", "mfa_bypass_events"}


def run_detections(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    *,
    run_id: str,
    output_root: str | None = None,
    tables: str | Iterable[str] | None = None,
    dry_run: bool = False,
    format: str = "parquet",
    write_options: Mapping[str, str] | None = None,
    as_of_date: str | _dt.date | None = None,
    params: Mapping[str, Mapping] | None = None,
) -> dict[str, int]:
    """Build, write and count the requested tables; returns {table: rows}."""
    validate_identifier(run_id, "run_id")
    if not dry_run and not output_root:
        raise ValueError("output_root is required unless dry_run")
    requested = set(select_tables(tables))
    counts: dict[str, int] = {}
    consumers = _consumers()
    held: list[DataFrame] = []

    def target(table: str) -> str:
        return f"{output_root.rstrip('/')}/{table}" if format in FILE_FORMATS else table

    def materialise(table: str, df: DataFrame) -> DataFrame:
        if table in requested and not dry_run:
            files = format in FILE_FORMATS
            if table in consumers and not files:
                # a connector's table cannot be read back here: its consumers
                # and the write itself start from the checkpoint
                ensure_checkpoint_dir(spark)
                df = df.checkpoint(eager=True)
            obs = Observation(f"rows_{table}")
            write_findings(df.observe(obs, F.count(F.lit(1)).alias("rows")), target(table),
                           format=format, options=write_options)
            counts[table] = int(obs.get["rows"])
            LOG.info("Detection %s wrote %s rows", table, counts[table])
            if table in consumers and files:
                # the known schema also covers a table written with no rows
                return spark.read.schema(df.schema).format(format).load(target(table))
            return df
        if table in requested:  # dry run: count only, keep for consumers
            kept = df.persist(StorageLevel.MEMORY_AND_DISK) if table in consumers else df
            if table in consumers:
                held.append(kept)
            counts[table] = kept.count()
            return kept
        # an input of a requested table that is not itself requested
        ensure_checkpoint_dir(spark)
        return df.checkpoint(eager=True)

    try:
        build_detections(frames, run_id, tables=requested, as_of_date=as_of_date,
                         params=params, resolve=materialise)
    finally:
        for df in held:
            df.unpersist()
    return counts


def run(
    spark: SparkSession,
    *,
    input_root: str,
    run_id: str,
    output_root: str | None = None,
    tables: str | Iterable[str] | None = None,
    dry_run: bool = False,
    format: str = "parquet",
    write_options: Mapping[str, str] | None = None,
    as_of_date: str | _dt.date | None = None,
) -> dict[str, int]:
    """End-to-end batch over landed sources under `input_root`."""
    apply_engine_conf(spark)
    guard_activity({s: scan_source(spark, input_root, s) for s in ACTIVITY_SOURCES})
    frames = load_sources(spark, input_root)
    # sources are read by many rules: keep the deduplicated, typed rows
    cached = {s: df.persist(StorageLevel.MEMORY_AND_DISK) for s, df in frames.items()}
    try:
        return run_detections(spark, cached, run_id=run_id, output_root=output_root, tables=tables,
                              dry_run=dry_run, format=format, write_options=write_options,
                              as_of_date=as_of_date)
    finally:
        for df in cached.values():
            df.unpersist()
