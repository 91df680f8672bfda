"""Independent SQL statements of every detection, for DuckDB parity checks.

These are written in the plain relational form (pair joins, per-key
windows, self-joins for the rolling frames) on purpose: they are the brute
force the Spark plans are checked against, on the small fixture scales only.
Each statement starts with the fixture views (`sources.fixtures`), so it
reads only the driver's base tables.
"""

from __future__ import annotations

from gatewatch import constants as K
from gatewatch.sources.fixtures import duckdb_with_clause

RUN_ID = "fixture-run"
AS_OF_DATE = "2024-02-01"


def _q(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def NS(x: str) -> str:
    return f"upper(trim(coalesce({x}, '')))"


def NB(x: str) -> str:
    return f"({x} IS NOT NULL AND trim({x}) <> '')"


def SEC(x: str) -> str:
    return f"CAST(epoch(date_trunc('second', {x})) AS BIGINT)"


def SET(x: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list({x}))), ',')"


APPROVED = f"{_q(K.APPROVED_STATUSES)}"
REJECTED = f"{_q(K.REJECTED_STATUSES)}"
PRIV = f"{_q(K.PRIVILEGED_GROUPS)}"


def _meta(name: str, ids: list[str], event: str | None, is_date: bool = False) -> str:
    parts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in ids)
    fid = f"sha256(concat_ws('{K.FINDING_ID_SEPARATOR}', '{name}', {parts}))"
    if event is None:
        ev = f"DATE '{AS_OF_DATE}'"
    elif is_date:
        ev = event
    else:
        ev = f"CAST({event} AS DATE)"
    ev = f"CAST({ev} AS VARCHAR)"
    return (
        f"'{name}' AS detection_name, {fid} AS finding_id, {ev} AS event_date, "
        f"'{RUN_ID}' AS pipeline_run_id"
    )


# ---------------------------------------------------------------- cores
# Each core is one SELECT (it may carry its own WITH) over the fixture views.

CORE: dict[str, str] = {}

CORE["impossible_login_anomalies"] = f"""
WITH succ AS (
  SELECT user_name, session_id AS login_session_id, ts AS login_ts FROM auth
  WHERE {NS('status')} = 'SUCCESS'),
pa AS (
  SELECT a.user_name, a.usage_id, a.session_id, a.app, o.login_ts AS login_time,
    a.ts AS app_access_time, {SEC('a.ts')} - {SEC('o.login_ts')} AS seconds_from_login
  FROM app a LEFT JOIN succ o
    ON a.user_name = o.user_name AND a.session_id = o.login_session_id AND {NB('o.login_session_id')}
  WHERE {NB('a.session_id')}),
pa_bad AS (
  SELECT *, CASE WHEN login_time IS NULL THEN 'missing_session_login'
                 WHEN seconds_from_login < 0 THEN 'application_before_login'
                 ELSE 'application_too_long_after_login' END AS anomaly_reason
  FROM pa WHERE login_time IS NULL OR seconds_from_login < 0 OR seconds_from_login > {K.LOGIN_TO_APP_MAX_SECONDS}),
pa_pick AS (
  SELECT user_name, usage_id, session_id, app, login_time, app_access_time, seconds_from_login, anomaly_reason
  FROM (SELECT *, row_number() OVER (PARTITION BY usage_id
          ORDER BY abs(seconds_from_login) ASC NULLS LAST, login_time ASC NULLS LAST) AS rn FROM pa_bad)
  WHERE rn = 1),
pb AS (
  SELECT a.user_name, a.usage_id, a.session_id, a.app, max(o.login_ts) AS login_time, a.ts AS app_access_time
  FROM app a LEFT JOIN succ o ON a.user_name = o.user_name AND o.login_ts <= a.ts
  WHERE NOT {NB('a.session_id')}
  GROUP BY a.user_name, a.usage_id, a.session_id, a.app, a.ts),
pb_bad AS (
  SELECT user_name, usage_id, session_id, app, login_time, app_access_time,
    {SEC('app_access_time')} - {SEC('login_time')} AS seconds_from_login,
    CASE WHEN login_time IS NULL THEN 'no_preceding_login' ELSE 'application_too_long_after_login' END
      AS anomaly_reason
  FROM pb
  WHERE login_time IS NULL OR {SEC('app_access_time')} - {SEC('login_time')} > {K.LOGIN_TO_APP_MAX_SECONDS})
SELECT user_name AS "user", usage_id, session_id, app, login_time, app_access_time, seconds_from_login,
  anomaly_reason FROM pa_pick
UNION ALL
SELECT user_name, usage_id, session_id, app, login_time, app_access_time, seconds_from_login,
  anomaly_reason FROM pb_bad
"""

CORE["mfa_bypass_events"] = f"""
WITH f AS (
  SELECT req_id AS failed_request_id, user_name AS failed_user, session_id AS failed_session_id,
    status AS failure_status, ts AS failure_ts
  FROM auth WHERE contains({NS('status')}, 'FAIL'))
SELECT a.user_name AS "user", f.failed_request_id, a.usage_id, f.failed_session_id,
  a.session_id AS app_session_id, f.failure_status, f.failure_ts AS mfa_failure_time, a.app,
  a.ts AS app_access_time, {SEC('a.ts')} - {SEC('f.failure_ts')} AS seconds_after_failure
FROM app a JOIN f ON a.user_name = f.failed_user AND a.ts > f.failure_ts
  AND {SEC('a.ts')} - {SEC('f.failure_ts')} <= {K.FAILURE_TO_APP_MAX_SECONDS}
  AND (NOT {NB('f.failed_session_id')} OR NOT {NB('a.session_id')} OR a.session_id = f.failed_session_id)
"""

CORE["mfa_bypass_events_all_apps"] = f"""
SELECT "user", failed_request_id, mfa_failure_time, failure_status,
  {SET('app')} AS applications_accessed, count(DISTINCT usage_id) AS usage_event_count,
  min(app_access_time) AS first_app_access_time, max(app_access_time) AS last_app_access_time
FROM ({CORE['mfa_bypass_events']}) d
GROUP BY "user", failed_request_id, mfa_failure_time, failure_status
"""

_LAT = " ".join(f"WHEN '{c}' THEN CAST({lat} AS DOUBLE)" for c, (lat, _) in K.COUNTRY_CENTROIDS.items())
_LON = " ".join(f"WHEN '{c}' THEN CAST({lon} AS DOUBLE)" for c, (_, lon) in K.COUNTRY_CENTROIDS.items())
CORE["impossible_travel_events"] = f"""
WITH s AS (
  SELECT *, CASE country {_LAT} END AS lat, CASE country {_LON} END AS lon
  FROM auth WHERE {NS('status')} = 'SUCCESS'),
p AS (
  SELECT *, lag(country) OVER w AS pc, lag(ts) OVER w AS pts, lag(lat) OVER w AS plat,
    lag(lon) OVER w AS plon
  FROM s WINDOW w AS (PARTITION BY user_name ORDER BY ts, req_id)),
c AS (
  SELECT *, {SEC('ts')} - {SEC('pts')} AS seconds_between,
    pow(sin(radians(lat - plat) / 2), 2)
      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2) AS h
  FROM p),
c2 AS (
  SELECT *, CAST({2 * K.EARTH_RADIUS_KM} AS DOUBLE)
    * asin(sqrt(CASE WHEN h > 1.0 THEN 1.0 ELSE h END)) AS dist
  FROM c)
SELECT user_name AS "user", req_id, pc AS previous_country, country AS current_country,
  pts AS previous_login_ts, ts AS current_login_ts, seconds_between,
  round(dist, 1) AS distance_km, round(dist / (seconds_between / 3600.0), 1) AS required_speed_kmh
FROM c2
WHERE pc IS NOT NULL AND country <> pc AND seconds_between > 0
  AND seconds_between <= {K.TRAVEL_MAX_SECONDS} AND dist IS NOT NULL
  AND dist / (seconds_between / 3600.0) > {K.TRAVEL_MAX_SPEED_KMH}
"""

_APPROVED_REQ = f"""(SELECT 1 FROM req r WHERE {NS('r.status')} IN ({APPROVED}) AND {NB('r.req_id')}
      AND r.req_id = d.request_id AND r.user_name = d.user_name)"""

CORE["privilege_escalation_without_request"] = f"""
SELECT d.user_name AS "user", d.event_id, d.request_id, d.group_name AS "group", d.initiator,
  d.ts AS escalation_time
FROM dir d
WHERE d.action = 'privilege_escalation' AND NOT EXISTS {_APPROVED_REQ}
"""

CORE["shadow_access_events"] = f"""
SELECT d.user_name AS "user", d.event_id, d.request_id, d.group_name AS privileged_group, d.action,
  d.initiator AS granted_by, d.ts AS grant_time
FROM dir d
WHERE d.group_name IN ({PRIV}) AND d.action IN ('add_member', 'privilege_escalation')
  AND NOT EXISTS {_APPROVED_REQ}
"""

def _spike_sql(days: int = K.BASELINE_DAYS, min_history: int = K.BASELINE_MIN_HISTORY,
               factor: float = K.SPIKE_FACTOR) -> str:
    return f"""
WITH daily AS (
  SELECT CAST(ts AS DATE) AS activity_date, action, count(*) AS event_count FROM dir GROUP BY 1, 2)
SELECT d.activity_date, d.action, d.event_count, avg(h.event_count) AS rolling_average,
  count(h.event_count) AS history_days
FROM daily d LEFT JOIN daily h ON h.action = d.action
  AND h.activity_date >= d.activity_date - {days} AND h.activity_date <= d.activity_date - 1
GROUP BY d.activity_date, d.action, d.event_count
HAVING count(h.event_count) >= {min_history}
  AND d.event_count > avg(h.event_count) * {factor}
"""


CORE["ad_volume_spikes"] = _spike_sql()

CORE["rejected_but_executed"] = f"""
SELECT d.user_name AS "user", d.event_id, d.request_id, r.status AS request_status,
  r.app AS requested_app, r.role AS requested_role, r.ts AS decision_time,
  d.group_name AS executed_group, d.action AS executed_action, d.ts AS execution_time
FROM dir d JOIN req r ON d.request_id = r.req_id AND d.user_name = r.user_name
WHERE {NS('r.status')} IN ({REJECTED})
"""

_SEQ = K.HIGH_RISK_SEQUENCE
CORE["high_risk_sequence"] = f"""
WITH k AS (
  SELECT *, CASE WHEN {NB('session_id')} THEN session_id ELSE 'user:' || user_name END AS session_key
  FROM app),
s AS (
  SELECT *, lag(app) OVER w AS previous_app, lead(app) OVER w AS next_app
  FROM k WINDOW w AS (PARTITION BY user_name, session_key ORDER BY ts, usage_id))
SELECT user_name AS "user", usage_id, session_id, previous_app, app AS current_app, next_app,
  ts AS sequence_time
FROM s WHERE previous_app = '{_SEQ[0]}' AND app = '{_SEQ[1]}' AND next_app = '{_SEQ[2]}'
"""

CORE["excessive_data_transferred"] = f"""
WITH daily AS (
  SELECT user_name, CAST(ts AS DATE) AS activity_date, sum(data_mb) AS total_data_mb
  FROM app GROUP BY 1, 2)
SELECT d.user_name AS "user", d.activity_date, d.total_data_mb,
  avg(h.total_data_mb) AS rolling_average_mb, count(h.total_data_mb) AS history_days
FROM daily d LEFT JOIN daily h ON h.user_name = d.user_name
  AND h.activity_date >= d.activity_date - {K.BASELINE_DAYS} AND h.activity_date <= d.activity_date - 1
GROUP BY d.user_name, d.activity_date, d.total_data_mb
HAVING count(h.total_data_mb) >= {K.BASELINE_MIN_HISTORY}
  AND d.total_data_mb > greatest(avg(h.total_data_mb) * {K.SPIKE_FACTOR}, {K.DATA_FLOOR_MB})
"""


def _first_last(src: str, keys: str, value: str, first: str, last: str) -> str:
    return f"""
f AS (SELECT {keys}, {value} AS {first} FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY ts ASC, req_id ASC) AS rn FROM {src} WHERE ts IS NOT NULL) WHERE rn = 1),
l AS (SELECT {keys}, {value} AS {last} FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
      ORDER BY ts DESC, req_id DESC) AS rn FROM {src} WHERE ts IS NOT NULL) WHERE rn = 1)"""


CORE["role_drift"] = f"""
WITH appr AS (SELECT * FROM req WHERE {NS('status')} IN ({APPROVED})),
{_first_last('appr', 'user_name, app', 'role', 'first_role', 'latest_role')},
g AS (SELECT user_name, app, min(ts) AS first_seen, max(ts) AS last_seen,
      count(DISTINCT role) AS distinct_roles FROM appr GROUP BY 1, 2)
SELECT g.user_name AS "user", g.app, f.first_role, l.latest_role, g.first_seen, g.last_seen,
  g.distinct_roles
FROM g LEFT JOIN f ON f.user_name = g.user_name AND f.app = g.app
  LEFT JOIN l ON l.user_name = g.user_name AND l.app = g.app
WHERE g.distinct_roles > 1 AND f.first_role <> l.latest_role
"""

def _stale_sql(days: int = K.STALE_DAYS) -> str:
    return f"""
WITH appr AS (SELECT * FROM req WHERE {NS('status')} IN ({APPROVED})),
{_first_last('appr', 'user_name, app', 'role', 'first_role', 'latest_role')},
g AS (SELECT user_name, app, max(ts) AS latest_grant_time FROM appr GROUP BY 1, 2),
u AS (SELECT user_name, app, max(ts) AS last_used_time FROM app GROUP BY 1, 2),
ao AS (SELECT max(ts) AS as_of_time FROM app),
j AS (
  SELECT g.user_name, g.app, g.latest_grant_time, l.latest_role, u.last_used_time, ao.as_of_time,
    CAST(date_diff('day', CAST(coalesce(u.last_used_time, g.latest_grant_time) AS DATE),
                   CAST(ao.as_of_time AS DATE)) AS INTEGER) AS inactive_days
  FROM g LEFT JOIN l ON l.user_name = g.user_name AND l.app = g.app
    LEFT JOIN u ON u.user_name = g.user_name AND u.app = g.app
    CROSS JOIN ao)
SELECT user_name AS "user", app, latest_grant_time, latest_role, last_used_time, as_of_time,
  inactive_days
FROM j WHERE inactive_days > {days}
"""


CORE["stale_access"] = _stale_sql()

CORE["multi_app_single_session"] = f"""
SELECT user_name AS "user", session_id, count(DISTINCT app) AS application_count,
  {SET('app')} AS applications, min(ts) AS session_start, max(ts) AS session_end
FROM app WHERE {NB('session_id')}
GROUP BY user_name, session_id
HAVING count(DISTINCT app) > {K.MULTI_APP_MORE_THAN}
"""

CORE["mfa_drift"] = f"""
WITH {_first_last('auth', 'user_name', 'mfa', 'first_mfa_method', 'latest_mfa_method').lstrip()},
g AS (SELECT user_name, count(DISTINCT mfa) AS distinct_mfa_methods,
      CAST(sum(CASE WHEN contains({NS('status')}, 'FAIL') THEN 1 ELSE 0 END) AS BIGINT) AS failed_attempts,
      count(*) AS total_attempts, max(ts) AS last_login_time
      FROM auth GROUP BY 1)
SELECT g.user_name AS "user", f.first_mfa_method, l.latest_mfa_method, g.distinct_mfa_methods,
  g.failed_attempts, g.total_attempts, g.last_login_time,
  CAST(g.failed_attempts AS DOUBLE) / g.total_attempts AS failure_rate
FROM g LEFT JOIN f ON f.user_name = g.user_name LEFT JOIN l ON l.user_name = g.user_name
WHERE g.distinct_mfa_methods > 1 AND f.first_mfa_method <> l.latest_mfa_method
"""

def _approver_sql(min_decisions: int = K.APPROVER_MIN_DECISIONS, high: float = K.APPROVER_HIGH_RATE,
                  low: float = K.APPROVER_LOW_RATE) -> str:
    return f"""
WITH g AS (
  SELECT approver, count(*) AS decision_count,
    CAST(sum(CASE WHEN {NS('status')} IN ({APPROVED}) THEN 1 ELSE 0 END) AS BIGINT) AS approved_count,
    CAST(sum(CASE WHEN {NS('status')} IN ({REJECTED}) THEN 1 ELSE 0 END) AS BIGINT) AS rejected_count,
    max(ts) AS latest_decision_time
  FROM req WHERE {NS('status')} IN ({APPROVED}, {REJECTED}) GROUP BY approver)
SELECT approver AS "user", decision_count, approved_count, rejected_count, latest_decision_time,
  CAST(approved_count AS DOUBLE) / decision_count AS approval_rate
FROM g
WHERE decision_count >= {min_decisions}
  AND (CAST(approved_count AS DOUBLE) / decision_count >= {high}
       OR CAST(approved_count AS DOUBLE) / decision_count <= {low})
"""


CORE["suspicious_approver_behavior"] = _approver_sql()

def _churn_sql(min_changes: int = K.CHURN_MIN_CHANGES) -> str:
    return f"""
SELECT user_name AS "user", group_name AS "group",
  CAST(sum(CASE WHEN action = 'add_member' THEN 1 ELSE 0 END) AS BIGINT) AS add_count,
  CAST(sum(CASE WHEN action = 'remove_member' THEN 1 ELSE 0 END) AS BIGINT) AS remove_count,
  count(*) AS change_count, max(ts) AS latest_change_time
FROM dir WHERE action IN ('add_member', 'remove_member')
GROUP BY user_name, group_name
HAVING count(*) >= {min_changes}
"""


CORE["ad_group_churn_rate"] = _churn_sql()

_EVENTS = """
  SELECT user_name, req_id AS source_event_id, 'okta' AS source, ts AS event_time FROM auth
  UNION ALL SELECT user_name, req_id, 'saviynt', ts FROM req
  UNION ALL SELECT user_name, event_id, 'ad', ts FROM dir
  UNION ALL SELECT user_name, usage_id, 'app_usage', ts FROM app"""

_ORPHANS = f"""
  SELECT * FROM ({_EVENTS}) ev
  WHERE NOT EXISTS (SELECT 1 FROM hr WHERE {NB('hr.user_name')} AND hr.user_name = ev.user_name)"""

CORE["orphan_event_detection"] = f"""
SELECT user_name AS "user", source_event_id, source, event_time FROM ({_ORPHANS}) o
"""

CORE["orphan_user_detection"] = f"""
SELECT user_name AS "user", {SET('source')} AS observed_sources, count(*) AS event_count
FROM ({_ORPHANS}) o GROUP BY user_name
"""

CORE["identity_timelines"] = """
SELECT user_name AS "user", ts AS event_time, 'okta_login' AS event_type, req_id AS source_event_id,
  concat_ws(' | ', 'status=' || status, 'country=' || country, 'mfa=' || mfa) AS details FROM auth
UNION ALL
SELECT user_name, ts, 'access_request', req_id,
  concat_ws(' | ', 'app=' || app, 'role=' || role, 'status=' || status) FROM req
UNION ALL
SELECT user_name, ts, 'directory_change', event_id,
  concat_ws(' | ', 'group=' || group_name, 'action=' || action, 'initiator=' || initiator) FROM dir
UNION ALL
SELECT user_name, ts, 'application_usage', usage_id,
  concat_ws(' | ', 'app=' || app, 'action=' || action, 'data_mb=' || CAST(data_mb AS VARCHAR)) FROM app
"""

CORE["suspicious_time_warp"] = f"""
WITH acts AS (
  SELECT request_id, user_name, event_id AS source_event_id, 'ad' AS source, ts AS action_ts
  FROM dir WHERE {NB('request_id')}
  UNION ALL
  SELECT request_id, user_name, usage_id, 'app_usage', ts FROM app WHERE {NB('request_id')})
SELECT a.user_name AS "user", a.request_id, a.source_event_id, a.source, a.action_ts AS action_time,
  r.ts AS approval_time, {SEC('r.ts')} - {SEC('a.action_ts')} AS seconds_before_approval
FROM acts a JOIN req r ON a.request_id = r.req_id AND a.user_name = r.user_name
WHERE {NS('r.status')} IN ({APPROVED}) AND {NB('r.req_id')} AND a.action_ts < r.ts
"""

_WEIGHTED = {
    "impossible_login": "impossible_login_anomalies",
    "mfa_bypass": "mfa_bypass_events",
    "impossible_travel": "impossible_travel_events",
    "shadow_access": "shadow_access_events",
    "privilege_escalation": "privilege_escalation_without_request",
    "rejected_but_executed": "rejected_but_executed",
    "excessive_data": "excessive_data_transferred",
    "stale_access": "stale_access",
    "orphan_event": "orphan_event_detection",
    "orphan_user": "orphan_user_detection",
    "time_warp": "suspicious_time_warp",
}
_CONTRIB = "\n  UNION ALL ".join(
    f"SELECT \"user\" AS u, '{factor}' AS f, {K.RISK_WEIGHTS[factor]} AS w FROM ({CORE[t]}) x{i}"
    for i, (factor, t) in enumerate(_WEIGHTED.items())
)
_LEVEL = " ".join(f"WHEN coalesce(a.risk_score, 0) >= {t} THEN '{n}'" for n, t in K.RISK_LEVELS)
CORE["risk_scores"] = f"""
WITH pop AS (
  SELECT DISTINCT u FROM (
    SELECT user_name AS u FROM hr UNION ALL SELECT user_name FROM auth
    UNION ALL SELECT user_name FROM dir UNION ALL SELECT user_name FROM app
    UNION ALL SELECT user_name FROM req) p
  WHERE {NB('u')}),
contrib AS (
  {_CONTRIB}
  UNION ALL SELECT user_name, '{K.KNOWN_ANOMALY_FACTOR}', {K.KNOWN_ANOMALY_WEIGHT} FROM known),
agg AS (
  SELECT u, CAST(sum(w) AS BIGINT) AS risk_score, {SET('f')} AS risk_factors, count(*) AS finding_count
  FROM contrib WHERE {NB('u')} GROUP BY u)
SELECT pop.u AS "user", coalesce(a.risk_score, 0) AS risk_score, a.risk_factors,
  coalesce(a.finding_count, 0) AS finding_count,
  CASE {_LEVEL} ELSE '{K.RISK_LEVEL_DEFAULT}' END AS risk_level
FROM pop LEFT JOIN agg a ON a.u = pop.u
"""

CORE["cleanest_users"] = f"""
SELECT "user", risk_score, risk_level, finding_count, risk_factors
FROM ({CORE['risk_scores']}) r
ORDER BY risk_score ASC, finding_count ASC, "user" ASC
LIMIT {K.CLEANEST_USERS}
"""

# Lower-threshold variants of the rules that yield very few rows on the
# fixtures: same rule, thresholds passed as parameters (name -> table, params).
VARIANTS = {
    "stale_access_15_days": ("stale_access", {"days": 15}),
    "ad_group_churn_2_changes": ("ad_group_churn_rate", {"min_changes": 2}),
    "suspicious_approver_2_decisions": ("suspicious_approver_behavior",
                                        {"min_decisions": 2, "high": 0.6, "low": 0.4}),
    "ad_volume_spikes_relaxed": ("ad_volume_spikes", {"min_history": 1, "factor": 1.5}),
}
_VARIANT_SQL = {
    "stale_access": _stale_sql,
    "ad_group_churn_rate": _churn_sql,
    "suspicious_approver_behavior": _approver_sql,
    "ad_volume_spikes": _spike_sql,
}

# table -> (detection_name, identity, event column, event is a date)
META = {
    "impossible_login_anomalies": ("impossible_login", ["usage_id", "anomaly_reason"], "app_access_time", False),
    "mfa_bypass_events": ("mfa_bypass", ["failed_request_id", "usage_id"], "app_access_time", False),
    "mfa_bypass_events_all_apps": ("mfa_bypass_all_apps", ["failed_request_id"], "first_app_access_time", False),
    "impossible_travel_events": ("impossible_travel", ["req_id", "previous_country", "current_country"], "current_login_ts", False),
    "privilege_escalation_without_request": ("privilege_escalation_without_request", ["event_id"], "escalation_time", False),
    "ad_volume_spikes": ("ad_volume_spike", ["activity_date", "action"], "activity_date", True),
    "rejected_but_executed": ("rejected_but_executed", ["event_id", "request_id"], "execution_time", False),
    "high_risk_sequence": ("high_risk_sequence", ["usage_id"], "sequence_time", False),
    "excessive_data_transferred": ("excessive_data_transferred", ['"user"', "activity_date"], "activity_date", True),
    "role_drift": ("role_drift", ['"user"', "app", "first_role", "latest_role"], "last_seen", False),
    "stale_access": ("stale_access", ['"user"', "app", "latest_role"], "as_of_time", False),
    "multi_app_single_session": ("multi_app_single_session", ['"user"', "session_id"], "session_start", False),
    "mfa_drift": ("mfa_drift", ['"user"', "first_mfa_method", "latest_mfa_method"], "last_login_time", False),
    "suspicious_approver_behavior": ("suspicious_approver_behavior", ['"user"'], "latest_decision_time", False),
    "ad_group_churn_rate": ("ad_group_churn", ['"user"', '"group"'], "latest_change_time", False),
    "orphan_event_detection": ("orphan_event", ["source", "source_event_id"], "event_time", False),
    "orphan_user_detection": ("orphan_user", ['"user"'], None, False),
    "cleanest_users": ("cleanest_users", ['"user"'], None, False),
    "shadow_access_events": ("shadow_access", ["event_id"], "grant_time", False),
    "risk_scores": ("security_reputation", ['"user"'], None, False),
    "identity_timelines": ("identity_timeline", ["event_type", "source_event_id"], "event_time", False),
    "suspicious_time_warp": ("suspicious_time_warp", ["source", "source_event_id", "request_id"], "action_time", False),
}


# date-typed result columns, shown as ISO text like the Spark side
DATE_COLUMNS = {"ad_volume_spikes": ["activity_date"], "excessive_data_transferred": ["activity_date"]}


def detection_sql(table: str, core: str | None = None) -> str:
    name, ids, event, is_date = META[table]
    core = CORE[table] if core is None else core
    star = "t.*"
    if table in DATE_COLUMNS:
        casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in DATE_COLUMNS[table])
        star = f"t.* REPLACE ({casts})"
    return (
        duckdb_with_clause()
        + f"\nSELECT {star}, {_meta(name, ids, event, is_date)}\nFROM ({core.strip()}) t"
    )


def detection_sqls() -> dict[str, str]:
    out = {t: detection_sql(t) for t in META}
    for name, (table, params) in VARIANTS.items():
        out[name] = detection_sql(table, _VARIANT_SQL[table](**params))
    return out


# ---------------------------------------------------------------- operators on their own

_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]
_TS_TEXT = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"

OPERATOR_CORE: dict[str, str] = {}

OPERATOR_CORE["dedup_latest_lineitem"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _LI_REST)}) AS rn
  FROM lineitem) x WHERE rn = 1
"""

OPERATOR_CORE["asof_latest_login"] = """
SELECT a.usage_id, a.user_name AS "user", a.ts AS app_ts, l.login_ts, l.login_req_id
FROM app a LEFT JOIN (
  SELECT a2.usage_id, o.ts AS login_ts, o.req_id AS login_req_id,
    row_number() OVER (PARTITION BY a2.usage_id ORDER BY o.ts DESC, o.req_id DESC) AS rn
  FROM app a2 JOIN auth o ON o.user_name = a2.user_name AND o.ts <= a2.ts) l
  ON l.usage_id = a.usage_id AND l.rn = 1
"""

OPERATOR_CORE["asof_next_use"] = """
SELECT o.req_id, o.user_name AS "user", o.ts AS login_ts, n.app_ts, n.next_usage_id
FROM auth o LEFT JOIN (
  SELECT o2.req_id, a.ts AS app_ts, a.usage_id AS next_usage_id,
    row_number() OVER (PARTITION BY o2.req_id ORDER BY a.ts ASC, a.usage_id ASC) AS rn
  FROM auth o2 JOIN app a ON a.user_name = o2.user_name AND a.ts >= o2.ts) n
  ON n.req_id = o.req_id AND n.rn = 1
"""

OPERATOR_CORE["interval_login_app_pairs"] = f"""
SELECT o.req_id, a.usage_id, a.user_name AS "user", {SEC('a.ts')} - {SEC('o.ts')} AS seconds_after
FROM auth o JOIN app a ON a.user_name = o.user_name AND a.ts > o.ts
  AND {SEC('a.ts')} - {SEC('o.ts')} <= 600
"""

OPERATOR_CORE["unmatched_directory_requests"] = """
SELECT d.event_id, d.user_name AS "user", d.request_id, d.action FROM dir d
WHERE NOT EXISTS (SELECT 1 FROM req r WHERE r.req_id = d.request_id AND r.user_name = d.user_name)
"""

OPERATOR_CORE["rolling_daily_events"] = """
WITH daily AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS events FROM events GROUP BY 1, 2)
SELECT d.event_type, CAST(d.day AS VARCHAR) AS day, d.events, avg(h.events) AS rolling_average,
  count(h.events) AS history_days
FROM daily d LEFT JOIN daily h ON h.event_type = d.event_type
  AND h.day >= d.day - 7 AND h.day <= d.day - 1
GROUP BY d.event_type, d.day, d.events
"""

OPERATOR_CORE["event_sequences"] = """
WITH s AS (
  SELECT event_id, user_id, ts, event_type, lag(event_type) OVER w AS p, lead(event_type) OVER w AS n
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT event_id, user_id, ts FROM s WHERE p = 'view' AND event_type = 'click' AND n = 'purchase'
"""

OPERATOR_CORE["login_moves"] = f"""
WITH s AS (SELECT *, CASE country {_LAT} END AS lat, CASE country {_LON} END AS lon FROM auth),
p AS (
  SELECT *, lag(country) OVER w AS pc, lag(ts) OVER w AS pts, lag(lat) OVER w AS plat,
    lag(lon) OVER w AS plon
  FROM s WINDOW w AS (PARTITION BY user_name ORDER BY ts, req_id)),
c AS (
  SELECT *, {SEC('ts')} - {SEC('pts')} AS seconds_between,
    pow(sin(radians(lat - plat) / 2), 2)
      + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2) AS h
  FROM p),
c2 AS (
  SELECT *, CAST({2 * K.EARTH_RADIUS_KM} AS DOUBLE)
    * asin(sqrt(CASE WHEN h > 1.0 THEN 1.0 ELSE h END)) AS dist FROM c)
SELECT req_id, user_name AS "user", pc AS previous_place, seconds_between,
  round(dist, 3) AS distance_km,
  round(CASE WHEN seconds_between = 0 THEN NULL ELSE dist / (seconds_between / 3600.0) END, 3)
    AS required_speed_kmh
FROM c2
"""

OPERATOR_CORE["order_priority_drift"] = """
WITH f AS (SELECT o_custkey, o_orderpriority AS first_priority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate ASC, o_orderkey ASC) AS rn
    FROM orders WHERE o_orderdate IS NOT NULL) x WHERE rn = 1),
l AS (SELECT o_custkey, o_orderpriority AS latest_priority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate IS NOT NULL) x WHERE rn = 1),
g AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS distinct_priorities,
      min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY 1)
SELECT g.o_custkey, f.first_priority, l.latest_priority, g.distinct_priorities, g.first_order,
  g.last_order
FROM g LEFT JOIN f ON f.o_custkey = g.o_custkey LEFT JOIN l ON l.o_custkey = g.o_custkey
"""

OPERATOR_CORE["supplier_line_rates"] = """
SELECT l_suppkey, count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
  count(*) FILTER (WHERE l_linestatus = 'O') AS open_lines, count(*) AS lines,
  max(l_shipdate) AS last_ship,
  CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) / count(*) AS return_rate
FROM lineitem GROUP BY l_suppkey
"""

OPERATOR_CORE["daily_event_variety"] = f"""
SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {SET('event_type')} AS type_set,
  min(ts) AS first_ts, max(ts) AS last_ts, count(DISTINCT event_type) AS types
FROM events GROUP BY user_id, CAST(ts AS DATE) HAVING count(DISTINCT event_type) > 3
"""

_CUST_LEVEL = " ".join(f"WHEN coalesce(a.risk_score, 0) >= {t} THEN '{n}'" for n, t in K.RISK_LEVELS)
OPERATOR_CORE["customer_scores"] = f"""
WITH pop AS (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS u FROM customer),
contrib AS (
  SELECT CAST(o_custkey AS VARCHAR) AS u, 'open_order' AS f, 1 AS w FROM orders WHERE o_orderstatus = 'O'
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'urgent_order', 3 FROM orders WHERE o_orderpriority = '1-URGENT'
  UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'large_order', 2 FROM orders WHERE o_totalprice > 300000),
agg AS (SELECT u, CAST(sum(w) AS BIGINT) AS risk_score, {SET('f')} AS risk_factors,
        count(*) AS finding_count FROM contrib WHERE {NB('u')} GROUP BY u)
SELECT pop.u AS "user", coalesce(a.risk_score, 0) AS risk_score, a.risk_factors,
  coalesce(a.finding_count, 0) AS finding_count,
  CASE {_CUST_LEVEL} ELSE '{K.RISK_LEVEL_DEFAULT}' END AS risk_level
FROM pop LEFT JOIN agg a ON a.u = pop.u
WHERE {NB('pop.u')}
"""

OPERATOR_CORE["order_finding_ids"] = """
SELECT o_orderkey, o_orderstatus, o_orderdate, 'order_check' AS detection_name,
  sha256(concat_ws('||', 'order_check', coalesce(CAST(o_orderkey AS VARCHAR), ''),
                   coalesce(CAST(o_orderstatus AS VARCHAR), ''))) AS finding_id,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS event_date, 'fixture-run' AS pipeline_run_id
FROM orders
"""

OPERATOR_CORE["page_identifiers"] = """
SELECT page_id, coalesce(nullif(substring(regexp_replace(regexp_replace(trim(url),
    '[^a-zA-Z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), 1, 63), ''), 'manual') AS identifier
FROM pages
"""

OPERATOR_CORE["envelope_round_trip"] = f"""
SELECT req_id, user_name AS "user", {_TS_TEXT} AS ts, country, mfa, status, session_id,
  'fixture-run' AS _pipeline_run_id
FROM auth
"""

OPERATOR_CORE["aligned_logins"] = f"""
SELECT req_id, user_name AS "user", {_TS_TEXT} AS ts, CAST(NULL AS VARCHAR) AS device,
  CAST(NULL AS VARCHAR) AS ip, country, mfa, status, session_id,
  CAST(NULL AS VARCHAR) AS _pipeline_run_id, CAST(NULL AS VARCHAR) AS _pubsub_message_id,
  CAST(NULL AS VARCHAR) AS _ingested_at
FROM auth
"""

OPERATOR_CORE["landed_latest"] = f"""
SELECT usage_id, user_name AS "user", {_TS_TEXT} AS ts, app, action, '' AS session_id,
  'run-2' AS _pipeline_run_id
FROM app
"""

_ACTIVITY_COUNTS = " UNION ALL ".join(
    f"SELECT '{source}' AS source, count(*) AS n_rows, "
    + ("count(*) FILTER (WHERE session_id = '')" if view in ("auth", "app") else "CAST(0 AS BIGINT)")
    + f" AS n_blank FROM {view}"
    for view, source in [("auth", "okta"), ("app", "app_usage"), ("req", "saviynt"), ("dir", "ad"),
                         ("hr", "hrlifecycle"), ("known", "anomaly_key")]
)
OPERATOR_CORE["envelope_counts_by_source"] = f"""
{_ACTIVITY_COUNTS} UNION ALL SELECT 'rejects', CAST(0 AS BIGINT), CAST(0 AS BIGINT)
"""

OPERATOR_CORE["inactive_buyers"] = f"""
SELECT b.user_id, {_TS_TEXT.replace("ts", "b.bought", 1)} AS bought,
  {_TS_TEXT.replace("ts", "c.last_click", 1)} AS last_click,
  CAST(date_diff('day', CAST(coalesce(c.last_click, b.bought) AS DATE), CAST(a.at AS DATE)) AS INT) AS inactive_days
FROM (SELECT user_id, max(ts) AS bought FROM events WHERE event_type = 'purchase' GROUP BY user_id) b
LEFT JOIN (SELECT user_id, max(ts) AS last_click FROM events WHERE event_type = 'click' GROUP BY user_id) c
  ON b.user_id = c.user_id
CROSS JOIN (SELECT max(ts) AS at FROM events WHERE event_type = 'click') a
WHERE date_diff('day', CAST(coalesce(c.last_click, b.bought) AS DATE), CAST(a.at AS DATE)) > 3
"""


def operator_sqls() -> dict[str, str]:
    w = duckdb_with_clause()
    return {k: f"{w}\nSELECT * FROM ({v.strip()}) q" for k, v in OPERATOR_CORE.items()}
