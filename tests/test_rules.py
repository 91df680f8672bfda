"""Rule semantics at their thresholds, null handling and invariants."""

from __future__ import annotations

from helpers import at, frames
from pyspark.sql import functions as F

from gatewatch.plans import rules as R
from gatewatch.plans.registry import TABLES, build_detections


def login(rid, user, sec, status="SUCCESS", session="S1", country="USA", mfa="push"):
    return (rid, user, at(sec), country, mfa, status, session)


def use(uid, user, sec, session="S1", app="GitHub", req=None, mb="1"):
    return (uid, user, at(sec), app, "click", mb, session, req)


def test_impossible_login_thresholds(spark):
    f = frames(
        spark,
        okta=[login("L1", "u1", 0), login("L2", "u2", 0, session=""), login("L3", "u3", 100)],
        app_usage=[
            use("U1", "u1", 1800), use("U2", "u1", 1801), use("U3", "u1", -5),
            use("U4", "u2", 1800, session=""), use("U5", "u2", 1801, session=""),
            use("U6", "u2", -1, session=""), use("U7", "u9", 10, session="S9"),
            use("U8", "u3", 99.5),  # same whole second boundary: 99 - 100 < 0
        ],
    )
    got = {r["usage_id"]: (r["anomaly_reason"], r["seconds_from_login"])
           for r in R.impossible_login(f["okta"], f["app_usage"]).collect()}
    assert got == {
        "U2": ("application_too_long_after_login", 1801),
        "U3": ("application_before_login", -5),
        "U5": ("application_too_long_after_login", 1801),
        "U6": ("no_preceding_login", None),
        "U7": ("missing_session_login", None),
        "U8": ("application_before_login", -1),
    }


def test_impossible_login_picks_closest_offending_login(spark):
    f = frames(
        spark,
        okta=[login("L1", "u", 0), login("L2", "u", 3000), login("L3", "u", 10000), login("L4", "u", 5100)],
        app_usage=[use("U1", "u", 5000)],
    )
    rows = R.impossible_login(f["okta"], f["app_usage"]).collect()
    # bad logins: L1 (5000 s before), L2 (2000 s before), L4 (100 s after), L3 (5000 after)
    assert [(r["usage_id"], r["seconds_from_login"], r["anomaly_reason"]) for r in rows] == [
        ("U1", -100, "application_before_login")]


def test_mfa_bypass_window_and_sessions(spark):
    f = frames(
        spark,
        okta=[login("F1", "u", 0, status="mfa_failed", session="S1")],
        app_usage=[use("U1", "u", 0.5), use("U2", "u", 3600), use("U3", "u", 3601),
                   use("U4", "u", 100, session="S2"), use("U5", "u", 200, session=" "),
                   use("U6", "u", -1)],
    )
    got = {r["usage_id"]: r["seconds_after_failure"] for r in R.mfa_bypass(f["okta"], f["app_usage"]).collect()}
    assert got == {"U1": 0, "U2": 3600, "U5": 200}


def test_impossible_travel_speed_and_unknown(spark):
    f = frames(spark, okta=[
        login("L1", "u", 0, country="USA"), login("L2", "u", 3600, country="Japan"),
        login("L3", "u", 3600 + 30000, country="UK"), login("L4", "u", 40000, country="Atlantis"),
        login("L5", "u", 40001, country="Germany"),
    ])
    got = [(r["req_id"], r["previous_country"]) for r in R.impossible_travel(f["okta"]).collect()]
    assert got == [("L2", "USA")]


def test_evidence_family(spark):
    f = frames(
        spark,
        ad=[("D1", "u", at(0), "DBA", "add_member", "svc", "R1"),
            ("D2", "u", at(0), "DBA", "add_member", "svc", "R2"),
            ("D3", "u", at(0), "HR", "privilege_escalation", "svc", None),
            ("D4", "u", at(0), "HR", "remove_member", "svc", "R3")],
        saviynt=[("R1", "u", at(10), "x", "admin", " approved", "m"),
                 ("R2", "other", at(10), "x", "admin", "APPROVED", "m"),
                 ("R3", "u", at(-10), "x", "admin", "denied", "m")],
    )
    assert sorted(r["event_id"] for r in R.shadow_access(f["ad"], f["saviynt"]).collect()) == ["D2"]
    assert [r["event_id"] for r in R.privilege_escalation_without_request(f["ad"], f["saviynt"]).collect()] == ["D3"]
    assert [r["event_id"] for r in R.rejected_but_executed(f["ad"], f["saviynt"]).collect()] == ["D4"]
    warp = R.suspicious_time_warp(f["ad"], f["app_usage"], f["saviynt"]).collect()
    assert [(r["source_event_id"], r["seconds_before_approval"]) for r in warp] == [("D1", 10)]


def test_stale_access_boundary(spark):
    f = frames(
        spark,
        saviynt=[("R1", "u", at(days=0), "A", "admin", "APPROVED", "m"),
                 ("R2", "u", at(days=0), "B", "admin", "APPROVED", "m")],
        app_usage=[use("U1", "x", 0, app="Z"), use("U2", "x", 0, app="Y").__class__(
            ("U2", "x", at(days=46), "Y", "click", "1", "S", None)),
            ("U3", "u", at(days=1), "B", "click", "1", "S", None)],
    )
    got = {r["app"]: r["inactive_days"] for r in R.stale_access(f["app_usage"], f["saviynt"]).collect()}
    assert got == {"A": 46}


def test_orphans_keep_null_users(spark):
    f = frames(spark, okta=[login("L1", None, 0), login("L2", "u1", 0), login("L3", "ghost", 0)],
               hrlifecycle=[("u1",), (" ",)])
    ev = R.source_events(f["okta"], f["saviynt"], f["ad"], f["app_usage"])
    orphans = R.orphan_events(ev, f["hrlifecycle"])
    assert sorted((r["user"] or "") for r in orphans.collect()) == ["", "ghost"]
    users = R.orphan_users(orphans).collect()
    assert sorted((r["user"] or "", r["event_count"]) for r in users) == [("", 1), ("ghost", 1)]


def test_all_tables_ids_unique_and_invariants(spark):
    f = frames(
        spark,
        okta=[login("L1", "u1", 0), login("L2", "u1", 100, status="FAILED"), login("L3", "u2", 0, country="UK")],
        app_usage=[use("U1", "u1", 200), use("U2", "u1", 5000), use("U3", "zz", 0, session="")],
        saviynt=[("R1", "u1", at(0), "A", "admin", "APPROVED", "m")],
        ad=[("D1", "u1", at(0), "DBA", "add_member", "svc", None)],
        hrlifecycle=[("u1",), ("u2",), ("u3",)],
        anomaly_key=[("u1", "x"), ("u1", "y")],
    )
    out = build_detections(f, "t", as_of_date="2024-03-10")
    assert set(out) == set(TABLES)
    for name, df in out.items():
        assert {"detection_name", "finding_id", "event_date", "pipeline_run_id", "detected_at"} <= set(df.columns)
        ids = [r["finding_id"] for r in df.select("finding_id").collect()]
        assert None not in ids and len(ids) == len(set(ids)), name
    assert out["identity_timelines"].count() == 3 + 3 + 1 + 1
    risk = {r["user"]: r for r in out["risk_scores"].collect()}
    assert set(risk) == {"u1", "u2", "u3", "zz"}
    # u1: impossible_login (U2: 4900 s after L1) 3 + mfa_bypass (U1 after L2) 5 + shadow 5 + labels 2
    assert risk["u1"]["risk_score"] == 15 and risk["u1"]["risk_level"] == "CRITICAL"
    assert risk["u3"]["risk_score"] == 0 and risk["u3"]["risk_factors"] is None
    assert out["cleanest_users"].count() == 4


def test_impossible_login_null_user_never_matches(spark):
    """H18: a use with no user matches no login, on either path."""
    f = frames(
        spark,
        okta=[login("L1", "u1", 0), login("L2", "u1", 0, session="")],
        app_usage=[use("U1", None, 10), use("U2", None, 10, session=""), use("U3", "u1", 10)],
    )
    got = {r["usage_id"]: r["anomaly_reason"] for r in R.impossible_login(f["okta"], f["app_usage"]).collect()}
    assert got == {"U1": "missing_session_login", "U2": "no_preceding_login"}


def test_finding_id_separator_collision_is_documented(spark):
    """H10: identities are joined with '||', so ('a||b', 'c') and ('a', 'b||c')
    share an id; the format is kept for id stability."""
    from gatewatch.functions.findings import finding_id

    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    ids = [r[0] for r in df.select(finding_id("n", [F.col("x"), F.col("y")])).collect()]
    assert ids[0] == ids[1]


def test_impossible_login_untimed_login_counts_only_as_last_resort(spark):
    """A session login without a usable time makes a use a finding only when
    no timed login of the session offends."""
    rows = [login("L1", "u", 0, session="S1"), ("L2", "u", None, "USA", "push", "SUCCESS", "S1"),
            ("L3", "u", None, "USA", "push", "SUCCESS", "S2"), login("L4", "u", 100, session="S2")]
    f = frames(spark, okta=rows, app_usage=[use("U1", "u", 5000, session="S1"),
                                            use("U2", "u", 200, session="S2"),
                                            use("U3", "u", 50, session="S3")])
    got = {r["usage_id"]: (r["anomaly_reason"], r["seconds_from_login"])
           for r in R.impossible_login(f["okta"], f["app_usage"]).collect()}
    assert got == {
        "U1": ("application_too_long_after_login", 5000),
        "U2": ("missing_session_login", None),
        "U3": ("missing_session_login", None),
    }
