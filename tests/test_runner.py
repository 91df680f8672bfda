"""Batch runner end to end: fixture sources -> envelopes -> landing -> run."""

from __future__ import annotations

import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gatewatch.oracle import AS_OF_DATE
from gatewatch.plans.queries import detection
from gatewatch.plans.registry import select_tables
from gatewatch.plans.runner import run, validate_identifier
from gatewatch.sources.contracts import SOURCE_REQUIRED_COLUMNS
from gatewatch.sources.envelope import decode_envelopes, encode_records
from gatewatch.sources.fixtures import fixture_sources
from gatewatch.sources.landing import land

SF = "/root/testdata/sf0.001"


def _as_landed_strings(frames):
    """Fixture sources as the all-string rows a publisher would send."""
    out = {}
    for source, df in frames.items():
        cols = []
        for c in SOURCE_REQUIRED_COLUMNS[source]:
            if c in df.columns:
                expr = F.col(c)
                if c == "ts":
                    expr = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
                cols.append(expr.cast("string").alias(c))
        out[source] = df.select(*cols)
    return out


@pytest.fixture(scope="module")
def landed(spark):
    if not Path(SF).exists():
        pytest.skip("test data not present")
    root = tempfile.mkdtemp(prefix="gw-landed-")
    env = encode_records(_as_landed_strings(fixture_sources(spark, SF)), "test", "r1")
    by_source, rejects = decode_envelopes(env, "test")
    assert rejects.count() == 0
    land(by_source, root)
    return root


def test_select_tables():
    assert select_tables(" risk_scores , cleanest_users,") == ["cleanest_users", "risk_scores"]
    assert len(select_tables("")) == 22
    with pytest.raises(ValueError):
        select_tables("nope")
    with pytest.raises(ValueError):
        validate_identifier("bad id", "run_id")


def test_run_writes_same_rows_as_queries(spark, landed):
    out = tempfile.mkdtemp(prefix="gw-out-")
    tables = "risk_scores,cleanest_users,impossible_login_anomalies,identity_timelines,ad_volume_spikes"
    counts = run(spark, input_root=landed, output_root=out, run_id="r1", tables=tables,
                 as_of_date=AS_OF_DATE)
    assert set(counts) == set(tables.split(","))
    for t, n in counts.items():
        assert n == detection(spark, SF, t).count(), t
        if n:
            assert spark.read.parquet(f"{out}/{t}").count() == n
    assert counts["cleanest_users"] == 10


def test_dry_run_counts_without_writing(spark, landed):
    counts = run(spark, input_root=landed, run_id="r2", tables="mfa_bypass_events_all_apps", dry_run=True)
    assert counts == {"mfa_bypass_events_all_apps": detection(spark, SF, "mfa_bypass_events_all_apps").count()}


def test_guard_refuses_empty_activity(spark):
    with pytest.raises(RuntimeError):
        run(spark, input_root=tempfile.mkdtemp(), run_id="r3", dry_run=True)


def test_cli_end_to_end(spark, tmp_path):
    """publish -> ingest -> run through the command line entry point."""
    from gatewatch.__main__ import main
    from gatewatch.sources.contracts import SOURCE_FILES

    data = tmp_path / "csv"
    data.mkdir()
    for source, name in SOURCE_FILES.items():
        cols = SOURCE_REQUIRED_COLUMNS[source]
        vals = {c: f"{source}-{c}" for c in cols}
        vals.update({"ts": "2024-01-01 00:00:00", "user": "u1"} if "ts" in cols else {"user": "u1"})
        (data / name).write_text(",".join(cols) + "\n" + ",".join(vals[c] for c in cols) + "\n")
    assert main(["check-csv", str(data)]) == 0
    assert main(["publish", str(data), str(tmp_path / "env"), "--env", "dev", "--run-id", "r 1"]) == 0
    assert main(["ingest", str(tmp_path / "env"), str(tmp_path / "land"),
                 "--checkpoint", str(tmp_path / "ck"), "--env", "dev"]) == 0
    assert main(["run", str(tmp_path / "land"), "--run-id", "r1", "--dry-run",
                 "--tables", "identity_timelines,risk_scores"]) == 0
