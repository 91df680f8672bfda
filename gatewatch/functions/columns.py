"""Column expressions shared by the rules. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewatch.constants import EARTH_RADIUS_KM, IDENTIFIER_FALLBACK, IDENTIFIER_MAX_LENGTH


def _c(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def normalized_status(column: str | Column) -> Column:
    """upper(trim(coalesce(c, ''))). `trim` removes spaces only."""
    return F.upper(F.trim(F.coalesce(_c(column), F.lit(""))))


def nonblank(column: str | Column) -> Column:
    """True when the value is present and not only spaces; never null."""
    c = _c(column)
    return F.coalesce(c.isNotNull() & (F.trim(c) != ""), F.lit(False))


def blank(column: str | Column) -> Column:
    return ~nonblank(column)


def epoch_seconds(column: str | Column) -> Column:
    """Whole seconds since the epoch (fractions dropped), for TIMESTAMP or
    TIMESTAMP_NTZ input. Differences of these are the rules' `seconds`."""
    return F.unix_timestamp(_c(column))


def session_key(session: str = "session_id", user: str = "user") -> Column:
    """The session, or one stand-in session per user for rows without one."""
    return F.when(nonblank(session), F.col(session)).otherwise(F.concat(F.lit("user:"), F.col(user)))


def safe_identifier(column: str | Column, fallback: str = IDENTIFIER_FALLBACK) -> Column:
    """Runs of characters outside [a-zA-Z0-9_-] become '-', leading and
    trailing '-'/'_' are stripped, the result is cut to 63 characters and an
    empty result falls back to `fallback`."""
    replaced = F.regexp_replace(F.trim(_c(column)), r"[^a-zA-Z0-9_-]+", "-")
    stripped = F.regexp_replace(replaced, r"^[-_]+|[-_]+$", "")
    cut = F.substring(stripped, 1, IDENTIFIER_MAX_LENGTH)
    return F.coalesce(F.nullif(cut, F.lit("")), F.lit(fallback))


def safe_identifier_text(value: str | None, fallback: str = IDENTIFIER_FALLBACK) -> str:
    """`safe_identifier` of one value on the driver."""
    joined = re.sub(r"[^a-zA-Z0-9_-]+", "-", (value or "").strip(" "))
    return joined.strip("-_")[:IDENTIFIER_MAX_LENGTH] or fallback


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; the inner term is clamped to 1 so rounding can
    never push asin into NaN."""
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(dlon / 2), 2
    )
    # clamp without `least`, which would skip a null (unknown place) and return 1
    clamped = F.when(h > F.lit(1.0), F.lit(1.0)).otherwise(h)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(clamped))


def details(*pairs: tuple[str, str | Column]) -> Column:
    """'k1=v1 | k2=v2'; a null value drops its part, a blank keeps `k=`."""
    return F.concat_ws(" | ", *[F.concat(F.lit(f"{k}="), _c(v).cast("string")) for k, v in pairs])
