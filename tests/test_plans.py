"""Plan shapes that carry the scale guarantees (checked on the physical plan)."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
# the only nested-loop join allowed: D11's one-row as-of time (a global
# aggregate), present in D11 and in the scores built on it
ONE_ROW_CROSS = {"stale_access", "stale_access_15_days", "risk_scores", "cleanest_users", "inactive_buyers"}


def _plan(spark, name: str) -> str:
    df = entry.queries()[name](spark, SF)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module", autouse=True)
def _data():
    if not Path(SF).exists():
        pytest.skip("test data not present")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_pair_enumeration(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan
    assert plan.count("BroadcastNestedLoopJoin") == (1 if name in ONE_ROW_CROSS else 0)


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(spark, "dedup_latest_lineitem")
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) and final


def test_interval_join_is_bucketed(spark):
    plan = _plan(spark, "mfa_bypass_events")
    assert "explode(sequence(" in plan
    assert "_lb" in plan and "_rb" in plan  # equi-join keys include the time bucket


def test_filters_reach_the_scan(spark):
    plan = _plan(spark, "mfa_drift")
    assert "DataFilters: [event_type" in plan or "PushedFilters: [In(event_type" in plan


def _static_plan(spark, name: str) -> str:
    """The plan without adaptive execution, where reused exchanges show."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _plan(spark, name)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name,scans", [
    ("event_sequences", 1), ("login_moves", 1), ("impossible_travel_events", 1), ("high_risk_sequence", 1),
    ("asof_latest_login", 2), ("asof_next_use", 2), ("impossible_login_anomalies", 5)])
def test_ordered_scans_read_their_input_once(spark, name, scans):
    """One exchange of the input by (key, bucket): the second level reuses it."""
    plan = _static_plan(spark, name)
    assert plan.count("FileScan") == scans
    assert plan.count("ReusedExchange") >= 1


def test_envelopes_are_parsed_once(spark):
    plan = _static_plan(spark, "envelope_counts_by_source")
    assert plan.count("parse_json") + plan.count("parseJson") <= 2  # the generator shows its input once more at most
    assert plan.count("FileScan") <= 7  # six sources, one of which also counts the customers
