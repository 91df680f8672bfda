"""Column-level helpers."""

from gatewatch.functions.columns import (
    blank,
    details,
    epoch_seconds,
    haversine_km,
    nonblank,
    normalized_status,
    safe_identifier,
    session_key,
)
from gatewatch.functions.findings import METADATA_COLUMNS, as_findings, finding_id

__all__ = [
    "METADATA_COLUMNS",
    "as_findings",
    "blank",
    "details",
    "epoch_seconds",
    "finding_id",
    "haversine_km",
    "nonblank",
    "normalized_status",
    "safe_identifier",
    "session_key",
]
