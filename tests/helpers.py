"""Hand-made canonical source frames for rule tests."""

from __future__ import annotations

import datetime as dt

T0 = dt.datetime(2024, 3, 1, 8, 0, 0)

SCHEMAS = {
    "okta": "req_id string, user string, ts timestamp, country string, mfa string, status string, session_id string",
    "app_usage": "usage_id string, user string, ts timestamp, app string, action string, data_mb string, session_id string, request_id string",
    "saviynt": "req_id string, user string, ts timestamp, app string, role string, status string, approver string",
    "ad": "event_id string, user string, ts timestamp, group string, action string, initiator string, request_id string",
    "hrlifecycle": "user string",
    "anomaly_key": "user string, anomaly_description string",
}


def at(seconds: float = 0, days: float = 0) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds, days=days)


def frames(spark, **rows):
    return {s: spark.createDataFrame(rows.get(s, []), SCHEMAS[s]) for s in SCHEMAS}
