"""Evidence joins and the bucketed interval join.

Join strategy is left to Catalyst + AQE: with adaptive execution on, a side
whose *measured* shuffle output is under the broadcast threshold is
broadcast at runtime, everything else stays a sort-merge join, and skewed
partitions of inner/anti joins are split by the skew-join rule. No side is
broadcast on a guess here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.columns import epoch_seconds


# begins the stand-in for a null key; a control character no identifier holds
_NO_KEY = "\u0001"


def _on(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for lc, rc in pairs:
        term = left[lc] == right[rc]
        cond = term if cond is None else cond & term
    return cond


def without_evidence(
    actions: DataFrame,
    evidence: DataFrame,
    on: Sequence[tuple[str, str]],
    *,
    split_null_keys: bool = False,
    salt: str | None = None,
) -> DataFrame:
    """Actions with no evidence row matching every (action col, evidence col)
    pair; an action with a null key never matches and is kept.

    Null keys all hash to one shuffle partition. `salt` names a column of the
    actions (an event id, say) that spreads them: a null text key is replaced,
    for the join only, by a value made of it that no evidence can hold.
    `split_null_keys=True` instead keeps null-keyed actions out of the join
    altogether, at the price of reading `actions` twice. With neither, the
    adaptive skew-join rule may split that partition.
    """
    ev = evidence.select(*[F.col(rc).alias(f"_ev_{i}") for i, (_, rc) in enumerate(on)])
    any_null = None
    cond = None
    for i, (lc, _) in enumerate(on):
        key = actions[lc]
        if salt is not None:
            key = F.coalesce(key, F.concat(F.lit(_NO_KEY), F.coalesce(actions[salt].cast("string"), F.lit(""))))
        term = key == ev[f"_ev_{i}"]
        cond = term if cond is None else cond & term
        isnull = F.col(lc).isNull()
        any_null = isnull if any_null is None else any_null | isnull
    if not split_null_keys:
        return actions.join(ev, cond, "left_anti")
    keyed = actions.filter(~any_null)
    return keyed.join(ev, cond, "left_anti").unionByName(actions.filter(any_null))


def with_evidence(
    actions: DataFrame,
    evidence: DataFrame,
    on: Sequence[tuple[str, str]],
    condition: Column | None = None,
) -> DataFrame:
    """Inner equi join of actions to evidence, plus an optional residual
    predicate evaluated on the joined row. Column names must not clash."""
    cond = _on(actions, evidence, on)
    if condition is not None:
        cond = cond & condition
    return actions.join(evidence, cond, "inner")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    left_time: str,
    right_time: str,
    within_seconds: int,
    *,
    condition: Column | None = None,
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Pairs with equal keys where `right_time > left_time` and the whole-second
    difference is at most `within_seconds`.

    Plain `key = key AND t BETWEEN` plans as a sort-merge join on the key alone,
    which pairs every left row with every right row of the key before the
    range test. Here both sides also join on a time bucket: a right row sits
    in one bucket, a left row is copied into the few buckets its window
    touches (`within_seconds / bucket_seconds + 2` at most), so each output
    pair is produced exactly once and a hot key is spread over its buckets.
    Column names of the two sides must not clash.
    """
    width = bucket_seconds or max(60, within_seconds // 4)
    lsec = epoch_seconds(left_time)
    first = F.floor(lsec / F.lit(width)).cast("long")
    last = F.floor((lsec + F.lit(within_seconds)) / F.lit(width)).cast("long")
    l = left.withColumn("_lb", F.explode(F.sequence(first, last)))
    r = right.withColumn("_rb", F.floor(epoch_seconds(right_time) / F.lit(width)).cast("long"))
    cond = _on(l, r, on) & (l["_lb"] == r["_rb"])
    diff = epoch_seconds(r[right_time]) - epoch_seconds(l[left_time])
    cond = cond & (r[right_time] > l[left_time]) & (diff <= F.lit(within_seconds))
    if condition is not None:
        cond = cond & condition
    return l.join(r, cond, "inner").drop("_lb", "_rb")
