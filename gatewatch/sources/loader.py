"""Reading sources under their contracts (CSV files, landed Parquet)."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gatewatch.operators.dedup import latest_by_key
from gatewatch.sources.csv_records import csv_records
from gatewatch.sources.contracts import (
    SOURCE_FILES,
    SOURCE_ID_COLUMNS,
    SOURCE_REQUIRED_COLUMNS,
    SOURCE_SCHEMAS,
    canonical,
)

LOG = logging.getLogger("gatewatch.sources")

CORRUPT = "_corrupt_record"


# RFC 4180: a doubled quote is a quote, and a quoted field may hold line breaks
CSV_OPTIONS = {"quote": '"', "escape": '"'}


def csv_path(data_dir: str, source: str) -> str:
    """Path of a source's CSV file; any path that Spark reads."""
    return f"{data_dir.rstrip('/')}/{SOURCE_FILES[source]}"


def _header(spark: SparkSession, path: str) -> list[str]:
    # the first record only: Spark reads no further for the column names
    return spark.read.options(**CSV_OPTIONS, header="true", multiLine="true", inferSchema="false").csv(path).columns


def _parsed(spark: SparkSession, path: str, columns: list[str], **options: str) -> DataFrame:
    """The records of a CSV file without the header, parsed; a large file is many
    tasks."""
    ddl = ", ".join("`" + c.replace("`", "``") + "` string" for c in columns)
    rows = csv_records(spark, path).filter(~F.col("first"))
    return rows.select(F.from_csv("record", ddl, {**CSV_OPTIONS, **options}).alias("r")).select("r.*")


def read_csv_source(spark: SparkSession, path: str, source: str) -> DataFrame:
    """The source's contract columns of a CSV file, bound by header name.

    Columns may come in any order, extra ones (lineage columns too) are left
    out, contract columns without a header are null, and a blank value is ''."""
    header = _header(spark, path)
    found = _parsed(spark, path, header)
    return found.select(*[
        (F.coalesce(F.col(f"`{c}`"), F.lit("")) if c in header else F.lit(None).cast("string")).alias(c)
        for c in SOURCE_REQUIRED_COLUMNS[source]
    ])


def check_source_files(spark: SparkSession, data_dir: str) -> DataFrame:
    """Violations of the CSV contract as a DataFrame (source, kind, detail, row).

    * `missing_file`: a configured file does not exist;
    * `missing_columns`: the header lacks required columns;
    * `malformed_row`: a row whose field count differs from the header's;
    * `invalid_utf8`: a line that is not valid UTF-8.

    Files are found and read by Spark, so any file system it reads will do. Row
    checks parse the records of a file (`csv_records`) in PERMISSIVE mode with a
    corrupt-record column. An empty result means the files may be published.
    """
    schema = StructType([StructField(n, StringType()) for n in ("source", "kind", "detail", "row")])
    parts: list[DataFrame] = []
    problems: list[tuple[str, str, str, str | None]] = []
    for source in SOURCE_FILES:
        path = csv_path(data_dir, source)
        try:
            header = _header(spark, path)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            problems.append((source, "missing_file", path, None))
            continue
        missing = sorted(set(SOURCE_REQUIRED_COLUMNS[source]) - set(header))
        if missing:
            problems.append((source, "missing_columns", ", ".join(missing), None))
            continue
        rows = _parsed(spark, path, [*header, CORRUPT], mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)

        def violation(df: DataFrame, kind: str, row: Column, source: str = source, path: str = path) -> DataFrame:
            return df.select(F.lit(source).alias("source"), F.lit(kind).alias("kind"), F.lit(path).alias("detail"),
                             row.alias("row"))

        parts.append(violation(rows.filter(F.col(CORRUPT).isNotNull()), "malformed_row", F.col(CORRUPT)))
        lines = spark.read.text(path)
        parts.append(violation(lines.filter(~F.is_valid_utf8("value")), "invalid_utf8", F.make_valid_utf8("value")))
    out = spark.createDataFrame(problems, schema)
    for p in parts:
        out = out.unionByName(p)
    return out


def source_path(input_root: str, source: str) -> str:
    return f"{input_root.rstrip('/')}/{source}"


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """Project onto `schema`: present columns cast to the field type, missing
    ones added as typed nulls, extra ones dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schema.fields
        ]
    )


def dedup_source(df: DataFrame, source: str) -> DataFrame:
    """One row per identity: the latest landing wins (by `_ingested_at`, then
    the order of delivery within a batch, then message id); two hashes of the
    remaining columns break any tie, so the pick is deterministic and the sort
    keys stay narrow."""
    keys = list(SOURCE_ID_COLUMNS[source])
    order_cols = [c for c in ("_ingested_at", "_delivery", "_pubsub_message_id") if c in df.columns]
    rest = [F.col(c) for c in df.columns if c not in keys and c not in order_cols]
    order = [F.col(c).desc_nulls_last() for c in order_cols]
    return latest_by_key(df, keys, [*order, F.xxhash64(*rest).desc(), F.hash(*rest).desc()])


def scan_source(spark: SparkSession, input_root: str, source: str) -> DataFrame:
    """Landed rows of `source` as they are, under its fixed schema (any
    partition layout below its path); no rows where nothing has landed."""
    schema, path = SOURCE_SCHEMAS[source], source_path(input_root, source)
    reader = spark.read.schema(schema).option("recursiveFileLookup", True)
    try:
        return align(reader.parquet(path), schema)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            LOG.warning("source %s has not landed below %s", source, input_root)
            return spark.createDataFrame([], schema)
        raise


def load_source(
    spark: SparkSession, input_root: str, source: str, *, typed: bool = True
) -> DataFrame:
    """`scan_source` with one row per identity and (by default) the columns
    that rules order and subtract typed with `try_` casts."""
    frame = dedup_source(scan_source(spark, input_root, source), source)
    return canonical(source, frame) if typed else frame
