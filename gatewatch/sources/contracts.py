"""Source contracts: names, landed schemas, required columns and identities.

Landed data keeps every business column as a nullable string (the wire
format is JSON text); `canonical()` types the few columns the rules compute
on, once, with ANSI-safe `try_` functions so a bad value becomes null instead
of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

LINEAGE_COLUMNS = ("_pipeline_run_id", "_pubsub_message_id", "_ingested_at")

# Source names, file names, business columns and identities.
SOURCE_FILES: dict[str, str] = {
    "okta": "okta_logins.csv",
    "ad": "ad_group_events.csv",
    "app_usage": "app_usage.csv",
    "saviynt": "saviynt_requests.csv",
    "hrlifecycle": "hr_lifecycle.csv",
    "anomaly_key": "anomaly_key.csv",
}

SOURCE_REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "okta": ("req_id", "user", "ts", "device", "ip", "country", "mfa", "status", "session_id"),
    "ad": ("event_id", "ts", "user", "group", "action", "initiator", "ip", "request_id"),
    "app_usage": (
        "usage_id", "ts", "user", "app", "action", "duration", "data_mb", "session_id", "request_id",
    ),
    "saviynt": ("req_id", "user", "ts", "app", "role", "status", "approver", "justification"),
    "hrlifecycle": (
        "user", "join_date", "move_date1", "move_date2", "termination_date", "department",
        "job_role", "location",
    ),
    "anomaly_key": ("user", "anomaly_description"),
}

SOURCE_ID_COLUMNS: dict[str, tuple[str, ...]] = {
    "okta": ("req_id",),
    "ad": ("event_id",),
    "app_usage": ("usage_id",),
    "saviynt": ("req_id",),
    "hrlifecycle": ("user", "join_date"),
    "anomaly_key": ("user", "anomaly_description"),
}
# end of fixed values

KNOWN_SOURCES = frozenset(SOURCE_FILES)

# columns the detections read, per source (everything else is pruned before
# the deduplicated sources are cached for the run)
RULE_COLUMNS: dict[str, tuple[str, ...]] = {
    "okta": ("req_id", "user", "ts", "country", "mfa", "status", "session_id"),
    "ad": ("event_id", "user", "ts", "group", "action", "initiator", "request_id"),
    "app_usage": ("usage_id", "user", "ts", "app", "action", "data_mb", "session_id", "request_id"),
    "saviynt": ("req_id", "user", "ts", "app", "role", "status", "approver"),
    "hrlifecycle": ("user",),
    "anomaly_key": ("user",),
}
ACTIVITY_SOURCES = ("okta", "ad", "app_usage", "saviynt")


def string_schema(columns: tuple[str, ...]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


SOURCE_SCHEMAS: dict[str, StructType] = {
    source: string_schema(cols + LINEAGE_COLUMNS) for source, cols in SOURCE_REQUIRED_COLUMNS.items()
}


def _typed_columns() -> dict[str, dict[str, str]]:
    return {
        "okta": {"ts": "timestamp"},
        "ad": {"ts": "timestamp"},
        # data_mb stays text: the timeline prints it as it came, sums try_cast it
        "app_usage": {"ts": "timestamp"},
        "saviynt": {"ts": "timestamp"},
        "hrlifecycle": {},
        "anomaly_key": {},
    }


TYPED_COLUMNS = _typed_columns()


def _try_type(column: Column, target: str) -> Column:
    if target == "timestamp":
        return F.try_to_timestamp(column)
    return column.try_cast(target)


def canonical(source: str, df: DataFrame) -> DataFrame:
    """Type the computed-on columns of a landed (all-string) source frame.

    Columns already of a non-string type are left alone, so canonical frames
    built elsewhere (fixture views, typed streams) pass through unchanged.
    """
    types: dict[str, DataType] = {f.name: f.dataType for f in df.schema.fields}
    changes = {
        name: _try_type(F.col(name), target)
        for name, target in TYPED_COLUMNS[source].items()
        if name in types and isinstance(types[name], StringType)
    }
    return df.withColumns(changes) if changes else df
