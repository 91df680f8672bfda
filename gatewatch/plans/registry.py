"""Detection registry: table name -> rule, identity, event column, weight.

`build_detections` returns lazy DataFrames; nothing runs until a caller
acts on one, and only the requested tables' lineage is ever planned.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from gatewatch import constants as K
from gatewatch.functions.findings import as_findings
from gatewatch.plans import rules as R
from gatewatch.session import shared_folder
from gatewatch.sources.contracts import RULE_COLUMNS


@dataclass(frozen=True)
class RuleSpec:
    table: str
    detection_name: str
    identity: tuple[str, ...]
    event_column: str | None
    build: Callable[["Context"], DataFrame]
    event_is_date: bool = False
    factor: str | None = None  # risk factor name when the rule is weighted


@dataclass
class Context:
    frames: Mapping[str, DataFrame]
    params: Mapping[str, Mapping] = field(default_factory=dict)
    cache: dict[str, DataFrame] = field(default_factory=dict)
    findings: Callable[[str], DataFrame] | None = None

    def src(self, name: str) -> DataFrame:
        return self.frames[name]

    def p(self, table: str) -> dict:
        return dict(self.params.get(table, {}))

    def shared(self, key: str, make: Callable[[], DataFrame]) -> DataFrame:
        if key not in self.cache:
            self.cache[key] = make()
        return self.cache[key]

    def finding(self, table: str) -> DataFrame:
        assert self.findings is not None
        return self.findings(table)


def _events(c: Context) -> DataFrame:
    return c.shared(
        "events", lambda: R.source_events(c.src("okta"), c.src("saviynt"), c.src("ad"), c.src("app_usage")))


def _risk(c: Context) -> DataFrame:
    weighted = [
        (spec.factor, c.finding(spec.table), K.RISK_WEIGHTS[spec.factor])
        for spec in SPECS.values()
        if spec.factor
    ]
    population = [c.src(s) for s in ("hrlifecycle", "okta", "ad", "app_usage", "saviynt")]
    return R.risk_scores(population, weighted, c.src("anomaly_key"))


_S = RuleSpec
SPECS: dict[str, RuleSpec] = {
    s.table: s
    for s in [
        _S("impossible_login_anomalies", "impossible_login", ("usage_id", "anomaly_reason"),
           "app_access_time",
           lambda c: R.impossible_login(c.src("okta"), c.src("app_usage"),
                                        **c.p("impossible_login_anomalies")),
           factor="impossible_login"),
        _S("mfa_bypass_events", "mfa_bypass", ("failed_request_id", "usage_id"), "app_access_time",
           lambda c: R.mfa_bypass(c.src("okta"), c.src("app_usage"), **c.p("mfa_bypass_events")),
           factor="mfa_bypass"),
        _S("mfa_bypass_events_all_apps", "mfa_bypass_all_apps", ("failed_request_id",),
           "first_app_access_time",
           lambda c: R.mfa_bypass_all_apps(c.finding("mfa_bypass_events"))),
        _S("impossible_travel_events", "impossible_travel",
           ("req_id", "previous_country", "current_country"), "current_login_ts",
           lambda c: R.impossible_travel(c.src("okta"), **c.p("impossible_travel_events")),
           factor="impossible_travel"),
        _S("privilege_escalation_without_request", "privilege_escalation_without_request",
           ("event_id",), "escalation_time",
           lambda c: R.privilege_escalation_without_request(c.src("ad"), c.src("saviynt")),
           factor="privilege_escalation"),
        _S("ad_volume_spikes", "ad_volume_spike", ("activity_date", "action"), "activity_date",
           lambda c: R.ad_volume_spikes(c.src("ad"), **c.p("ad_volume_spikes")),
           event_is_date=True),
        _S("rejected_but_executed", "rejected_but_executed", ("event_id", "request_id"),
           "execution_time", lambda c: R.rejected_but_executed(c.src("ad"), c.src("saviynt")),
           factor="rejected_but_executed"),
        _S("high_risk_sequence", "high_risk_sequence", ("usage_id",), "sequence_time",
           lambda c: R.high_risk_sequence(c.src("app_usage"), **c.p("high_risk_sequence"))),
        _S("excessive_data_transferred", "excessive_data_transferred", ("user", "activity_date"),
           "activity_date",
           lambda c: R.excessive_data_transferred(c.src("app_usage"),
                                                  **c.p("excessive_data_transferred")),
           event_is_date=True, factor="excessive_data"),
        _S("role_drift", "role_drift", ("user", "app", "first_role", "latest_role"), "last_seen",
           lambda c: R.role_drift(c.src("saviynt"))),
        _S("stale_access", "stale_access", ("user", "app", "latest_role"), "as_of_time",
           lambda c: R.stale_access(c.src("app_usage"), c.src("saviynt"), **c.p("stale_access")),
           factor="stale_access"),
        _S("multi_app_single_session", "multi_app_single_session", ("user", "session_id"),
           "session_start",
           lambda c: R.multi_app_session(c.src("app_usage"), **c.p("multi_app_single_session"))),
        _S("mfa_drift", "mfa_drift", ("user", "first_mfa_method", "latest_mfa_method"),
           "last_login_time", lambda c: R.mfa_drift(c.src("okta"))),
        _S("suspicious_approver_behavior", "suspicious_approver_behavior", ("user",),
           "latest_decision_time",
           lambda c: R.suspicious_approver(c.src("saviynt"),
                                           **c.p("suspicious_approver_behavior"))),
        _S("ad_group_churn_rate", "ad_group_churn", ("user", "group"), "latest_change_time",
           lambda c: R.ad_group_churn(c.src("ad"), **c.p("ad_group_churn_rate"))),
        _S("orphan_event_detection", "orphan_event", ("source", "source_event_id"), "event_time",
           lambda c: R.orphan_events(_events(c), c.src("hrlifecycle")), factor="orphan_event"),
        _S("orphan_user_detection", "orphan_user", ("user",), None,
           lambda c: R.orphan_users(_events(c), c.src("hrlifecycle")), factor="orphan_user"),
        _S("cleanest_users", "cleanest_users", ("user",), None,
           lambda c: R.cleanest_users(c.finding("risk_scores"))),
        _S("shadow_access_events", "shadow_access", ("event_id",), "grant_time",
           lambda c: R.shadow_access(c.src("ad"), c.src("saviynt")), factor="shadow_access"),
        _S("risk_scores", "security_reputation", ("user",), None, _risk),
        _S("identity_timelines", "identity_timeline", ("event_type", "source_event_id"),
           "event_time",
           lambda c: R.identity_timeline(c.src("okta"), c.src("saviynt"), c.src("ad"),
                                         c.src("app_usage"))),
        _S("suspicious_time_warp", "suspicious_time_warp",
           ("source", "source_event_id", "request_id"), "action_time",
           lambda c: R.suspicious_time_warp(c.src("ad"), c.src("app_usage"), c.src("saviynt")),
           factor="time_warp"),
    ]
}

TABLES = tuple(SPECS)
# tables that read most rules' findings, and so every source many times
SCORED = frozenset({"risk_scores", "cleanest_users"})
# rules that read the request ids of directory or app events
REQUEST_RULES = frozenset({
    "privilege_escalation_without_request", "rejected_but_executed", "shadow_access_events", "suspicious_time_warp",
})


class StoredFrames(Mapping):
    """Source frames that are written when first asked for, narrowed to the columns
    that rules read, and then read from there: a source that is costly to derive is
    derived once, however many rules read it."""

    def __init__(self, frames: Mapping[str, DataFrame]) -> None:
        self.frames = frames
        self.stored: dict[str, DataFrame] = {}
        self.root: str | None = None

    def __getitem__(self, source: str) -> DataFrame:
        if source not in self.stored:
            df = self.frames[source]
            df = df.select(*[c for c in RULE_COLUMNS[source] if c in df.columns])
            self.root = self.root or shared_folder(df.sparkSession)
            df.write.parquet(f"{self.root}/{source}")
            self.stored[source] = df.sparkSession.read.schema(df.schema).parquet(f"{self.root}/{source}")
        return self.stored[source]

    def __iter__(self) -> Iterator[str]:
        return iter(self.frames)

    def __len__(self) -> int:
        return len(self.frames)


def select_tables(requested: str | Iterable[str] | None) -> list[str]:
    """The tables to build: a comma list or an iterable of names, sorted; all
    tables, in registry order, where it names none."""
    given = requested.split(",") if isinstance(requested, str) else requested or ()
    wanted = sorted({name.strip() for name in given} - {""})
    if bad := [name for name in wanted if name not in SPECS]:
        raise ValueError(f"no such table: {', '.join(bad)} (there are {', '.join(TABLES)})")
    return wanted or list(TABLES)


def build_detections(
    frames: Mapping[str, DataFrame],
    run_id: str,
    *,
    tables: str | Iterable[str] | None = None,
    as_of_date: str | _dt.date | None = None,
    with_detected_at: bool = True,
    params: Mapping[str, Mapping] | None = None,
    resolve: Callable[[str, DataFrame], DataFrame] | None = None,
    request_frames: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Lazy result frames (rule columns + metadata) for the requested tables.

    Rules that feed others (weighted findings into risk_scores, risk_scores
    into cleanest_users) are built once per call. `resolve(table, frame)`
    lets a runner substitute the materialised version of such an input
    (persisted or written table) so its lineage is not recomputed. Where the
    request ids of events are costly to derive, give `frames` without them and
    the frames that have them as `request_frames` (for `REQUEST_RULES`).
    """
    built: dict[str, DataFrame] = {}

    def finding(table: str) -> DataFrame:
        if table not in built:
            spec = SPECS[table]
            df = as_findings(
                spec.build(with_requests if table in REQUEST_RULES else ctx), spec.detection_name, spec.identity, spec.event_column, run_id,
                as_of_date=as_of_date, event_date_is_date=spec.event_is_date,
                with_detected_at=with_detected_at,
            )
            built[table] = resolve(table, df) if resolve else df
        return built[table]

    ctx = Context(frames=frames, params=params or {}, findings=finding)
    with_requests = Context(frames=request_frames or frames, params=params or {}, findings=finding)
    return {t: finding(t) for t in select_tables(tables)}
