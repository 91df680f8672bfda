"""Skew-safe ordered scans: as-of lookups and previous/next neighbours.

A plain `Window.partitionBy(user).orderBy(ts)` sends every row of a key to
one task, so a key holding a third of the data becomes a third of the job in
one task. The scans here work in two levels instead:

1. rows are cut into chunks `(key, bucket)` where `bucket` is a monotone
   function of the order column (e.g. the hour). A window over the chunk
   answers everything that does not cross a chunk border; chunks hash to
   different tasks, so a hot key is spread over as many tasks as it has
   active buckets;
2. what crosses a border is carried by a few rows per chunk, which are scanned
   per key: its outermost rows (`offsets`), or its one-row summary, joined back
   on `(key, bucket)` (`asof_join`, `running_extremes`).

Both levels are ordinary DataFrame operations that start from one exchange of
the input by `(key, bucket)`. Spark reuses an exchange only where both levels ask
it for the same columns; the levels are written so that they do (`_summary`).
Select the columns you need before a scan and not after it: a column dropped
later may be pruned from one level only, which costs a second exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_SECONDS = 3600
# chunk of the rows without an as-of key; below every real bucket
_NO_BUCKET = -(2**62)


def time_bucket(column: Column, width_seconds: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """Monotone bucket id (long) of a timestamp column."""
    return F.floor(F.unix_timestamp(column) / F.lit(width_seconds)).cast("long")


def number_bucket(column: Column, width: int = DEFAULT_BUCKET_SECONDS) -> Column:
    """Monotone bucket id (long) of a numeric column, e.g. epoch seconds."""
    return F.floor(column / F.lit(width)).cast("long")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_key: Column,
    right_key: Column,
    value: Column,
    *,
    bucket_of,
    direction: str = "backward",
    inclusive: bool = True,
    out: str = "asof_value",
    group_count: str | None = None,
) -> DataFrame:
    """As-of lookup without pairing rows.

    For every left row, `out` is the max (backward) or min (forward) of
    `value` over right rows with equal `by` columns and `right_key <=
    left_key` (backward) or `right_key >= left_key` (forward); with
    `inclusive=False` the comparison is strict. Give `value` as a struct whose
    first field is the right key to get the latest (earliest) right row, later
    fields breaking ties. Keys may be any orderable type (timestamps, longs,
    structs); `bucket_of(key)` must map them monotonically to long bucket ids.
    Right rows with a null key or null `by` never match; left rows with a null
    `by` or key get null.

    `group_count`, when given, names an extra column with the number of
    right rows of the left row's `by` group (0 when none); it comes from the
    per-chunk table, so it costs no extra pass over the data.

    Returns `left` with the extra column(s); the row count is unchanged.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction must be 'backward' or 'forward'")
    backward = direction == "backward"
    extreme = F.max if backward else F.min
    pick = F.greatest if backward else F.least

    l = left.withColumns({"_k": left_key, "_side": F.lit(1), "_v": F.lit(None).cast(
        right.select(value).schema[0].dataType)})
    r_keep = F.lit(True)
    for c in by:
        r_keep = r_keep & F.col(c).isNotNull()
    r = (
        right.withColumns({"_k": right_key, "_v": value})
        .filter(r_keep & F.col("_k").isNotNull())
        .select(*by, "_k", "_v", F.lit(0).alias("_side"))
    )
    # a row without a key gets a chunk of its own, so that it still finds its group's count
    both = l.unionByName(r, allowMissingColumns=True).withColumn(
        "_b", F.coalesce(bucket_of(F.col("_k")), F.lit(_NO_BUCKET)))

    # a struct is never null, even of nulls: the join below adds no null filter to
    # one of the levels, which would set their exchanges apart
    both = both.withColumn("_by", F.struct(*by)).repartition("_by", "_b")

    # level 1: running extreme inside each (key, bucket) chunk; at equal keys
    # right rows come first when inclusive, after the left row when strict
    key_order = F.col("_k").asc_nulls_first() if backward else F.col("_k").desc_nulls_last()
    side_order = F.col("_side").asc() if inclusive else F.col("_side").desc()
    local_w = (
        Window.partitionBy("_by", "_b")
        .orderBy(key_order, side_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = both.withColumn("_local", extreme("_v").over(local_w))

    # level 2: one row per chunk (left-only chunks included, so they receive a
    # carry), scanned per key
    chunk_order = F.col("_b").asc_nulls_first() if backward else F.col("_b").desc_nulls_last()
    chunks = _summary(both, ["_by", "_b"], {"_cv": extreme("_v"), "_cn": F.sum(F.lit(1) - F.col("_side"))})
    carried = chunks.select(
        "_by",
        "_b",
        extreme("_cv")
        .over(
            Window.partitionBy("_by")
            .orderBy(chunk_order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        .alias("_carry"),
        F.sum("_cn").over(Window.partitionBy("_by")).alias("_gcount"),
    )
    joined = local.filter(F.col("_side") == 1).join(carried, on=["_by", "_b"], how="left")
    result = F.when(F.col("_k").isNotNull(), pick(F.col("_local"), F.col("_carry")))
    outs = {out: result}
    if group_count:
        outs[group_count] = F.coalesce(F.col("_gcount"), F.lit(0).cast("long"))
    return joined.withColumns(outs).select(*left.columns, *outs.keys())


def _summary(chunked: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """One row per chunk of rows that are partitioned by `keys`, without another
    exchange. `_all` makes the summary ask for every column, like the level that
    returns the rows, so that both read the same exchange; it is never null and
    changes no value."""
    found = chunked.groupBy(*keys).agg(*[e.alias(n) for n, e in aggregates.items()], F.max(F.hash(*chunked.columns)).alias("_all"))
    return found.select(*keys, *[F.when(F.col("_all").isNotNull(), F.col(n)).alias(n) for n in aggregates])


def offsets(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    *,
    bucket: Column,
    before: Sequence[str] = (),
    after: Sequence[str] = (),
) -> DataFrame:
    """Skew-safe `lag(value, 1), lag(value, 2), ...` (named by `before`) and
    `lead(value, 1), ...` (`after`) over `keys` ordered by `order` (a total order;
    add an id as the last column).

    `bucket` must be a monotone function of the first order column (e.g.
    `time_bucket(ts)`). Most rows have all their neighbours in their chunk. Those
    among the first or last rows of a chunk, as many as the largest offset, go on
    to a window per key over such rows only, where rows next to a border are next
    to each other."""
    most = max(len(before), len(after))
    ord_cols = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    base = df.withColumns({"_b": bucket, "_val": value}).withColumn("_ord", F.struct(*ord_cols))
    chunk = Window.partitionBy(*keys, "_b")
    w = chunk.orderBy("_ord")
    local = base.withColumns(
        {"_left": F.row_number().over(w) - 1, "_size": F.count(F.lit(1)).over(chunk)}
        | {n: F.lag("_val", k).over(w) for k, n in enumerate(before, 1)}
        | {n: F.lead("_val", k).over(w) for k, n in enumerate(after, 1)}
    ).withColumn("_right", F.col("_size") - 1 - F.col("_left"))
    outer = (F.col("_left") < most) | (F.col("_right") < most)
    cw = Window.partitionBy(*keys).orderBy("_ord")
    border = local.filter(outer).withColumns(
        {n: F.when(F.col("_left") >= k, F.col(n)).otherwise(F.lag("_val", k).over(cw)) for k, n in enumerate(before, 1)}
        | {n: F.when(F.col("_right") >= k, F.col(n)).otherwise(F.lead("_val", k).over(cw)) for k, n in enumerate(after, 1)}
    )
    return local.filter(~outer).unionByName(border).select(*df.columns, *before, *after)


def neighbors(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    *,
    bucket: Column,
    prev: str | None = "prev",
    next: str | None = "next",
) -> DataFrame:
    """`offsets` by one row: columns `prev` and `next`."""
    return offsets(df, keys, order, value, bucket=bucket, before=[prev] if prev else [], after=[next] if next else [])


def running_extremes(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    *,
    bucket: Column,
    before: str | None = "max_before",
    after: str | None = "min_after",
) -> DataFrame:
    """Skew-safe `max(value)` over all earlier rows and `min(value)` over all
    later rows of the same `keys` (rows ordered by `order`, a total order;
    nulls ignored), i.e. the windows `ROWS BETWEEN UNBOUNDED PRECEDING AND 1
    PRECEDING` / `1 FOLLOWING AND UNBOUNDED FOLLOWING` without putting a
    key's whole history in one task. `bucket` must be monotone in the first
    order column."""
    ord_cols = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    base = df.withColumns({"_b": bucket, "_v": value}).withColumn("_ord", F.struct(*ord_cols))
    # see asof_join; rows of null keys or times are one group or chunk
    base = base.withColumns({"_by": F.struct(*keys), "_b": F.coalesce("_b", F.lit(_NO_BUCKET))}).repartition("_by", "_b")
    w = Window.partitionBy("_by", "_b").orderBy("_ord")
    cols = {}
    if before:
        cols["_lb"] = F.max("_v").over(w.rowsBetween(Window.unboundedPreceding, -1))
    if after:
        cols["_la"] = F.min("_v").over(w.rowsBetween(1, Window.unboundedFollowing))
    local = base.withColumns(cols)
    chunks = _summary(base, ["_by", "_b"], {"_cmax": F.max("_v"), "_cmin": F.min("_v")})
    cw = Window.partitionBy("_by").orderBy("_b")
    carried = chunks.select(
        "_by", "_b",
        F.max("_cmax").over(cw.rowsBetween(Window.unboundedPreceding, -1)).alias("_cb"),
        F.min("_cmin").over(cw.rowsBetween(1, Window.unboundedFollowing)).alias("_ca"),
    )
    joined = local.join(carried, on=["_by", "_b"], how="left")
    outs = {}
    if before:
        outs[before] = F.greatest("_lb", "_cb")
    if after:
        outs[after] = F.least("_la", "_ca")
    return joined.withColumns(outs).select(*df.columns, *outs.keys())
