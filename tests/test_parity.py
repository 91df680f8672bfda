"""Every registered query equals its DuckDB oracle on the smallest scale."""

from __future__ import annotations

import math
import re
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _rows(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].astype(object).itertuples(index=False):
        row = []
        for v in rec:
            if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) in ("NaT", "<NA>"):
                row.append(None)
            elif isinstance(v, float):
                row.append(round(v, 6))
            elif hasattr(v, "to_pydatetime"):
                row.append(v.to_pydatetime())
            else:
                row.append(v)
        out.append(tuple(row))
    return cols, sorted(out, key=repr)


@pytest.fixture(scope="module")
def con():
    if not Path(SF).exists():
        pytest.skip("test data not present")
    c = duckdb.connect()
    for t in TABLES:
        if Path(f"{SF}/{t}.parquet").exists():
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = _rows(entry.queries()[name](spark, SF).toPandas())
    exp = _rows(con.sql(entry.oracle_sql()[name]).df())
    assert got[0] == exp[0]
    assert got[1] == exp[1]


def test_every_query_has_an_oracle():
    """Learnt or iterative training-data operators (opN_, pipeline) are held
    against brute force in their own tests where SQL cannot express them."""
    beyond_sql = {q for q in entry.queries() if re.match(r"op\d+_|pipeline$", q)}
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - beyond_sql <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"user", "risk_score", "risk_level", "finding_id"} <= set(df.columns)


@pytest.mark.parametrize("name", [
    "impossible_login_anomalies", "mfa_bypass_events", "mfa_bypass_events_all_apps",
    "impossible_travel_events", "privilege_escalation_without_request", "rejected_but_executed",
    "high_risk_sequence", "excessive_data_transferred", "role_drift", "multi_app_single_session",
    "mfa_drift", "orphan_event_detection", "orphan_user_detection", "shadow_access_events",
    "risk_scores", "cleanest_users", "identity_timelines", "suspicious_time_warp"])
def test_finding_ids_unique(spark, name):
    """The end-to-end invariant: finding ids are never null and unique."""
    df = entry.queries()[name](spark, SF)
    stats = df.agg(F.count("*").alias("n"), F.count_distinct("finding_id").alias("ids"),
                   F.count_if(F.col("finding_id").isNull()).alias("nulls")).first()
    assert stats["nulls"] == 0 and stats["ids"] == stats["n"] and stats["n"] > 0
