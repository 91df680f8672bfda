"""Operators against brute force on hand-made and random rows."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gatewatch.operators.dedup import latest_by_key
from gatewatch.operators.joins import interval_join, with_evidence, without_evidence
from gatewatch.operators.scan import asof_join, neighbors, number_bucket, offsets, time_bucket
from gatewatch.operators.scoring import union_all
from gatewatch.operators.sequence import match_sequence
from gatewatch.operators.aggregates import rolling_baseline

T0 = dt.datetime(2024, 1, 1)


def ts(sec: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=sec)


def test_asof_backward_matches_brute_force(spark):
    rnd = random.Random(7)
    left = [(f"u{rnd.randint(0, 3)}", i, ts(rnd.randint(0, 20000))) for i in range(300)]
    left += [(None, 1000, ts(50)), ("u1", 1001, None)]
    right = [(f"u{rnd.randint(0, 3)}", ts(rnd.randint(0, 20000))) for _ in range(200)]
    right += [(None, ts(10)), ("u1", None)]
    ldf = spark.createDataFrame(left, "user string, id int, t timestamp")
    rdf = spark.createDataFrame(right, "user string, rt timestamp")
    out = asof_join(ldf, rdf, ["user"], F.col("t"), F.col("rt"), F.col("rt"),
                    bucket_of=lambda c: time_bucket(c, 600), out="hit")
    got = {r["id"]: r["hit"] for r in out.collect()}
    for user, i, t in left:
        cands = [r for u, r in right if u is not None and u == user and r is not None and t is not None and r <= t]
        assert got[i] == (max(cands) if cands else None), (user, i, t)
    assert out.count() == len(left)


def test_asof_forward_with_ties_and_numeric_keys(spark):
    left = [("a", 1, 100), ("a", 2, 5000), ("a", 3, 7200), ("b", 4, 10)]
    right = [("a", 100, "x"), ("a", 100, "w"), ("a", 7300, "y"), ("b", 5, "z")]
    ldf = spark.createDataFrame(left, "k string, id int, s long")
    rdf = spark.createDataFrame(right, "k string, rs long, tag string")
    out = asof_join(ldf, rdf, ["k"], F.col("s"), F.col("rs"), F.struct("rs", "tag"),
                    bucket_of=lambda c: number_bucket(c, 1000), direction="forward", out="nx")
    got = {r["id"]: (tuple(r["nx"]) if r["nx"] else None) for r in out.collect()}
    assert got == {1: (100, "w"), 2: (7300, "y"), 3: (7300, "y"), 4: None}


def test_neighbors_equal_plain_window(spark):
    rnd = random.Random(3)
    rows = [(f"k{rnd.randint(0, 2)}", i, ts(rnd.randint(0, 30000)), rnd.choice("ABC")) for i in range(400)]
    rows.append((None, 999, ts(5), "A"))
    df = spark.createDataFrame(rows, "k string, id int, t timestamp, v string")
    got = neighbors(df, ["k"], [F.col("t"), F.col("id")], F.col("v"),
                    bucket=time_bucket(F.col("t"), 900))
    w = Window.partitionBy("k").orderBy("t", "id")
    exp = df.select("id", F.lag("v").over(w).alias("prev"), F.lead("v").over(w).alias("next"))
    assert sorted(got.select("id", "prev", "next").collect()) == sorted(exp.collect())


def test_match_sequence_any_length(spark):
    vals = list("XABCDXABCXABCDABCD")
    rows = [("u", i, ts(i * 1000), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "user string, id int, t timestamp, v string")
    hits = match_sequence(df, ["user"], "t", "id", "v", ["A", "B", "C", "D"], anchor=1,
                          bucket_seconds=1500)
    exp = [i + 1 for i in range(len(vals) - 3) if vals[i:i + 4] == list("ABCD")]
    assert sorted(r["id"] for r in hits.collect()) == exp


def test_interval_join_matches_brute_force(spark):
    rnd = random.Random(11)
    left = [(f"u{rnd.randint(0, 2)}", i, ts(rnd.uniform(0, 10000))) for i in range(120)]
    right = [(f"u{rnd.randint(0, 2)}", 1000 + j, ts(rnd.uniform(0, 10000))) for j in range(150)]
    right.append(("u0", 5000, left[0][2] if left[0][0] == "u0" else ts(1)))
    ldf = spark.createDataFrame(left, "lu string, lid int, lt timestamp")
    rdf = spark.createDataFrame(right, "ru string, rid int, rt timestamp")
    out = interval_join(ldf, rdf, [("lu", "ru")], "lt", "rt", 900, bucket_seconds=200)
    got = sorted((r["lid"], r["rid"]) for r in out.collect())
    exp = sorted(
        (li, ri) for lu, li, lt in left for ru, ri, rt in right
        if lu == ru and rt > lt and int(rt.timestamp()) - int(lt.timestamp()) <= 900
    )
    assert got == exp


def test_evidence_joins_keep_null_keys(spark):
    acts = spark.createDataFrame([("r1", "u1"), (None, "u1"), ("r2", "u2")], "rid string, u string")
    ev = spark.createDataFrame([("r1", "u1"), ("r2", "x")], "erid string, eu string")
    out = without_evidence(acts, ev, [("rid", "erid"), ("u", "eu")])
    assert sorted((r["rid"] or "", r["u"]) for r in out.collect()) == [("", "u1"), ("r2", "u2")]
    inner = with_evidence(acts, ev, [("rid", "erid"), ("u", "eu")])
    assert [r["rid"] for r in inner.collect()] == ["r1"]


def test_latest_by_key_is_deterministic(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-02", "b"), (1, "2024-01-02", "a"), (1, "2024-01-01", "z"), (None, "x", "y"), (None, "w", "v")],
        "k int, at string, v string",
    )
    out = latest_by_key(df, ["k"], [F.col("at").desc(), F.col("v").desc()])
    assert sorted(out.collect(), key=str) == sorted(
        [(1, "2024-01-02", "b"), (None, "x", "y")], key=str)


def test_rolling_baseline_excludes_today_and_gaps(spark):
    days = [(dt.date(2024, 3, d), c) for d, c in [(1, 2), (2, 4), (5, 6), (9, 30), (20, 1)]]
    df = spark.createDataFrame([("a", d, c) for d, c in days], "k string, d date, c long")
    out = {r["d"].day: (r["rolling_average"], r["history_days"])
           for r in rolling_baseline(df, ["k"], "d", "c", days=7).collect()}
    assert out[1] == (None, 0)
    assert out[2] == (2.0, 1)
    assert out[5] == (3.0, 2)
    assert out[9] == (5.0, 2)  # days 2 and 5 within the 7 days before the 9th
    assert out[20] == (None, 0)


def test_strict_asof_excludes_equal_keys(spark):
    left = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("a", 3, 30)], "k string, id int, s long")
    right = spark.createDataFrame([("a", 10, 1), ("a", 20, 2), ("a", 30, 3)], "k string, rs long, rid int")
    bk = lambda c: number_bucket(c, 15)
    back = asof_join(left, right, ["k"], F.col("s"), F.col("rs"), F.col("rid"), bucket_of=bk,
                     inclusive=False, out="p")
    both = asof_join(back, right, ["k"], F.col("s"), F.col("rs"), F.col("rid"), bucket_of=bk,
                     direction="forward", inclusive=False, out="n")
    assert sorted((r["id"], r["p"], r["n"]) for r in both.collect()) == [(1, None, 2), (2, 1, 3), (3, 2, None)]


def test_linked_events_equal_sql_window(spark):
    from pathlib import Path

    import pytest

    from gatewatch.sources.fixtures import LINKED, linked_events

    path = "/root/testdata/sf0.01/events.parquet"
    if not Path(path).exists():
        pytest.skip("test data not present")
    ev = spark.read.parquet(path)
    exp = spark.sql(LINKED, events=ev)
    got = linked_events(ev)
    assert got.columns == exp.columns
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0


def test_without_evidence_split_null_keys_same_rows(spark):
    acts = spark.createDataFrame([("r1", "u1"), (None, "u1"), ("r2", "u2"), ("r3", None)], "rid string, u string")
    ev = spark.createDataFrame([("r1", "u1"), ("r2", "x")], "erid string, eu string")
    on = [("rid", "erid"), ("u", "eu")]
    plain = without_evidence(acts, ev, on)
    split = without_evidence(acts, ev, on, split_null_keys=True)
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))
    assert plain.count() == 3


def test_offsets_equal_plain_windows(spark):
    """Any offsets, over chunks of any size: one row, many rows, none; null keys and times."""
    rng = random.Random(12)
    rows = [(rng.choice([None, "a", "b", "c", f"solo{i}"]), rng.choice([None, rng.randint(0, 40), rng.randint(0, 4000)]), i, f"v{i}") for i in range(600)]
    df = spark.createDataFrame(rows, "k string, t long, id long, v string")
    w = Window.partitionBy("k").orderBy("t", "id")
    for width in (1, 10, 100_000):
        got = offsets(df, ["k"], [F.col("t"), F.col("id")], F.col("v"), bucket=number_bucket(F.col("t"), width),
                      before=["p1", "p2", "p3"], after=["n1", "n2"])
        exp = df.select("*", *[F.lag("v", i).over(w).alias(f"p{i}") for i in (1, 2, 3)], *[F.lead("v", i).over(w).alias(f"n{i}") for i in (1, 2)])
        assert sorted(got.collect(), key=str) == sorted(exp.collect(), key=str), width


def test_union_widens_types_and_fills_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, a string")
    b = spark.createDataFrame([(1.5, "y")], "n double, b string")
    got = union_all([a, b])
    assert got.columns == ["n", "a", "b"] and sorted(map(tuple, got.collect()), key=str) == [(1.0, "x", None), (1.5, None, "y")]
    long = spark.createDataFrame([(2**40, "z")], "n long, a string")
    assert sorted(r["n"] for r in union_all([a, long]).collect()) == [1, 2**40]
    with pytest.raises(ValueError):
        union_all([])
