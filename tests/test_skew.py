"""A key holding a third of all rows: the two-level scans stay exact and no
chunk (the unit a task processes) comes near the hot key's size."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gatewatch.operators.scan import neighbors, time_bucket
from gatewatch.sources.fixtures import LINKED, linked_events

PATH = "/root/testdata/sf0.01/events.parquet"


@pytest.fixture(scope="module")
def skewed(spark):
    if not Path(PATH).exists():
        pytest.skip("test data not present")
    ev = spark.read.parquet(PATH)
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def test_hot_key_share_and_chunk_bound(skewed):
    total = skewed.count()
    hot = skewed.groupBy("user_id").count().agg(F.max("count")).first()[0]
    chunk = (skewed.groupBy("user_id", time_bucket(F.col("ts"), 6 * 3600).alias("b"))
             .count().agg(F.max("count")).first()[0])
    assert hot >= total / 3
    assert chunk <= hot / 50


def test_scans_exact_under_skew(spark, skewed):
    exp = spark.sql(LINKED, events=skewed)
    got = linked_events(skewed)
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    nb = neighbors(skewed, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type"),
                   bucket=time_bucket(F.col("ts"), 3600))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    plain = skewed.select("event_id", F.lag("event_type").over(w).alias("prev"),
                          F.lead("event_type").over(w).alias("next"))
    assert nb.select("event_id", "prev", "next").exceptAll(plain).count() == 0


def test_hot_orphan_user_is_counted_before_the_join(spark):
    from pyspark.sql import functions as F

    from gatewatch.plans import rules as R

    events = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 500).cast("string"))).alias("user"),
        F.col("id").cast("string").alias("source_event_id"), F.lit("ad").alias("source"),
        F.lit("2024-01-01").cast("timestamp").alias("event_time"))
    hr = spark.range(0, 500, 2).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = R.orphan_users(events, hr)
        got = {r["user"]: r["event_count"] for r in out.collect()}
        plan = out._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got["hot"] == 10_000 and len(got) == 251
    assert plan.index("LeftAnti") < plan.rindex("Aggregate [user")  # an aggregate lies below the join


def test_null_keys_are_spread_by_the_salt(spark):
    from pyspark.sql import functions as F

    from gatewatch.operators.joins import without_evidence

    actions = spark.range(1000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 10 == 0, F.concat(F.lit("R"), F.col("id").cast("string"))).alias("request_id"))
    evidence = spark.range(0, 1000, 20).select(F.concat(F.lit("R"), F.col("id").cast("string")).alias("rid"))
    plain = without_evidence(actions, evidence, [("request_id", "rid")])
    salted = without_evidence(actions, evidence, [("request_id", "rid")], salt="event_id")
    assert sorted(plain.collect(), key=str) == sorted(salted.collect(), key=str) and plain.count() == 950
