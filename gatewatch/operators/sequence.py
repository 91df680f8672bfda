"""Ordered-sequence operators built on the skew-safe neighbour scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.columns import epoch_seconds, haversine_km
from gatewatch.operators.scan import DEFAULT_BUCKET_SECONDS, neighbors, offsets, time_bucket


def match_sequence(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: str,
    value: str,
    pattern: Sequence[str],
    *,
    anchor: int | None = None,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
    prefix: str = "seq",
) -> DataFrame:
    """Rows at position `anchor` (default: middle) of a run of consecutive
    values equal to `pattern`, per `keys` ordered by (`ts`, `tiebreak`).

    Adds `{prefix}_{i}` for every pattern position (`{prefix}_{anchor}` is the
    row's own value). Works for any pattern length, in one scan.
    """
    n = len(pattern)
    a = n // 2 if anchor is None else anchor
    if not 0 <= a < n:
        raise ValueError("anchor outside the pattern")
    out = offsets(
        df.withColumn(f"{prefix}_{a}", F.col(value)), keys, [F.col(ts), F.col(tiebreak)], F.col(value),
        bucket=time_bucket(F.col(ts), bucket_seconds),
        before=[f"{prefix}_{i}" for i in range(a - 1, -1, -1)], after=[f"{prefix}_{i}" for i in range(a + 1, n)])
    cond = F.lit(True)
    for i, expected in enumerate(pattern):
        cond = cond & F.coalesce(F.col(f"{prefix}_{i}") == F.lit(expected), F.lit(False))
    return out.filter(cond)


def geo_velocity(
    df: DataFrame,
    by: Sequence[str],
    ts: str,
    tiebreak: str,
    place: str,
    centroids: Mapping[str, tuple[float, float]],
    *,
    bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
) -> DataFrame:
    """Adds, from the previous row of the same `by` (ordered by ts, tiebreak):
    previous_place, previous_ts, seconds_between (whole seconds), distance_km
    between place centroids and required_speed_kmh. Places are looked up in a
    literal map (constant-folded, no join); unknown places give null."""
    lat_map = F.create_map(*[x for k, (lat, _) in centroids.items() for x in (F.lit(k), F.lit(lat))])
    lon_map = F.create_map(*[x for k, (_, lon) in centroids.items() for x in (F.lit(k), F.lit(lon))])
    base = df.withColumns(
        {
            "_lat": F.try_element_at(lat_map, F.col(place)),
            "_lon": F.try_element_at(lon_map, F.col(place)),
        }
    )
    val = F.struct(F.col(place).alias("place"), F.col(ts).alias("ts"),
                   F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))
    nb = neighbors(base, by, [F.col(ts), F.col(tiebreak)], val,
                   bucket=time_bucket(F.col(ts), bucket_seconds), prev="_p", next=None)
    seconds = epoch_seconds(F.col("_p.ts"))
    out = nb.withColumns(
        {
            "previous_place": F.col("_p.place"),
            "previous_ts": F.col("_p.ts"),
            "seconds_between": epoch_seconds(F.col(ts)) - seconds,
            "distance_km": haversine_km(F.col("_p.lat"), F.col("_p.lon"), F.col("_lat"), F.col("_lon")),
        }
    ).withColumn(
        "required_speed_kmh",
        F.try_divide(F.col("distance_km"), F.col("seconds_between") / F.lit(3600.0)),
    )
    return out.drop("_p", "_lat", "_lon")


def place_distance_km(a: str, b: str, centroids: Mapping[str, tuple[float, float]]) -> Column:
    """Great-circle distance between the centroids of two places; null where one
    is unknown."""
    at = [F.create_map(*[x for k, v in centroids.items() for x in (F.lit(k), F.lit(v[i]))]) for i in (0, 1)]
    return haversine_km(*(F.try_element_at(m, F.col(place)) for place in (a, b) for m in at))
