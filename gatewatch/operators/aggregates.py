"""Grouped operators. Every one is a single `groupBy().agg()` (map-side
partial aggregation, so a hot key is pre-reduced in each task before the
shuffle) or a window over an already aggregated, per-day table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ordered_by(ts: str | Column, tiebreak: str | Column) -> Column:
    """Ordering struct for min_by/max_by; null when the time is unknown so
    such rows are ignored, as `min_by(x, ts)` would."""
    return F.when(_c(ts).isNotNull(), F.struct(_c(ts).alias("t"), _c(tiebreak).alias("k")))


def first_last_drift(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tiebreak: str,
    value: str,
    *,
    first: str = "first_value",
    latest: str = "latest_value",
    first_seen: str | None = None,
    last_seen: str | None = None,
    distinct: str = "distinct_values",
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Per group: value at the earliest and latest time (ties by `tiebreak`),
    first/last time and the number of distinct values; `extra` adds more
    aggregates to the same pass. Rows are not filtered here."""
    order = ordered_by(ts, tiebreak)
    aggs = [
        F.min_by(value, order).alias(first),
        F.max_by(value, order).alias(latest),
        F.count_distinct(value).alias(distinct),
    ]
    if first_seen:
        aggs.append(F.min(ts).alias(first_seen))
    if last_seen:
        aggs.append(F.max(ts).alias(last_seen))
    for name, expr in (extra or {}).items():
        aggs.append(expr.alias(name))
    return df.groupBy(*keys).agg(*aggs)


def drifted(first: str, latest: str, distinct: str) -> Column:
    return (F.col(distinct) > 1) & (F.col(first) != F.col(latest))


def conditional_rates(
    df: DataFrame,
    keys: Sequence[str],
    counts: Mapping[str, Column],
    *,
    total: str | None = None,
    extra: Mapping[str, Column] | None = None,
    rates: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Per group, `count_if` of each condition, an optional total row count,
    extra aggregates and rates `name -> (numerator, denominator)`."""
    aggs = [F.count_if(_c(cond)).alias(name) for name, cond in counts.items()]
    if total:
        aggs.append(F.count(F.lit(1)).alias(total))
    for name, expr in (extra or {}).items():
        aggs.append(expr.alias(name))
    out = df.groupBy(*keys).agg(*aggs)
    if rates:
        out = out.withColumns(
            {name: F.try_divide(F.col(n).cast("double"), F.col(d)) for name, (n, d) in rates.items()}
        )
    return out


def session_diversity(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    ts: str,
    *,
    more_than: int,
    count_name: str = "value_count",
    set_name: str = "values",
    start: str = "start",
    end: str = "end",
) -> DataFrame:
    """Groups with more than `more_than` distinct values, the sorted value
    set, and first/last time. One `collect_set` pass gives both the count and
    the set (the set is bounded by the value domain)."""
    return (
        df.groupBy(*keys)
        .agg(
            F.sort_array(F.collect_set(value)).alias(set_name),
            F.min(ts).alias(start),
            F.max(ts).alias(end),
        )
        .withColumn(count_name, F.size(set_name).cast("long"))
        .filter(F.col(count_name) > more_than)
    )


def rolling_baseline(
    daily: DataFrame,
    keys: Sequence[str],
    date_col: str,
    value_col: str,
    *,
    days: int,
    average: str = "rolling_average",
    history: str = "history_days",
) -> DataFrame:
    """Adds the mean and the count of non-null `value_col` over the `days`
    calendar days before each row's date (today excluded). Days without a
    row are absent, not zero. The frame is in day numbers (`unix_date`), so a
    daylight-saving change cannot shorten it. `daily` is one row per key and
    day, so each window partition holds at most one row per day."""
    w = (
        Window.partitionBy(*keys)
        .orderBy(F.unix_date(F.col(date_col)))
        .rangeBetween(-days, -1)
    )
    return daily.withColumns(
        {average: F.avg(value_col).over(w), history: F.count(value_col).over(w)}
    )


def inactivity(
    grants: DataFrame,
    uses: DataFrame,
    keys: Sequence[str],
    *,
    granted: str,
    used: str,
    days: int,
    last_used: str = "last_used_time",
    as_of: str = "as_of_time",
    inactive: str = "inactive_days",
) -> DataFrame:
    """Grants (one row per `keys`, with a time `granted`) not used for more than
    `days` days before the latest use anywhere. Days count from the last use of
    the same keys, or from the grant if there is none."""
    last = uses.groupBy(*keys).agg(F.max(used).alias(last_used))
    # one row by construction: a global aggregate; broadcasting it is safe
    now = uses.agg(F.max(used).alias(as_of))
    since = F.to_date(F.coalesce(F.col(last_used), F.col(granted)))
    return (
        grants.join(last, list(keys), "left")
        .crossJoin(F.broadcast(now))
        .withColumn(inactive, F.datediff(F.to_date(as_of), since))
        .filter(F.col(inactive) > days)
    )
