"""Rule constants.

Fixed values: these must stay equal to the detection semantics the engine
re-implements (group names, status words, country centroids, thresholds,
weights). They are data, not logic; thresholds are defaults that every
operator also accepts as a parameter.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
PRIVILEGED_GROUPS = ("Security-Admins", "DBA", "DevOps")
APPROVED_STATUSES = ("APPROVED", "COMPLETED")
REJECTED_STATUSES = ("REJECTED", "DENIED")
SUCCESS_STATUS = "SUCCESS"
FAILURE_MARKER = "FAIL"

GRANT_ACTIONS = ("add_member", "privilege_escalation")
ESCALATION_ACTION = "privilege_escalation"
CHURN_ACTIONS = ("add_member", "remove_member")

# country -> (latitude, longitude)
COUNTRY_CENTROIDS = {
    "USA": (38.0, -97.0),
    "UK": (54.0, -2.0),
    "India": (22.0, 79.0),
    "Japan": (36.0, 138.0),
    "Brazil": (-10.0, -55.0),
    "Singapore": (1.35, 103.82),
    "Germany": (51.0, 9.0),
    "Australia": (-25.0, 133.0),
    "Canada": (56.0, -106.0),
}
EARTH_RADIUS_KM = 6371.0

HIGH_RISK_SEQUENCE = ("GitHub", "Snowflake", "Databricks")

LOGIN_TO_APP_MAX_SECONDS = 1800
FAILURE_TO_APP_MAX_SECONDS = 3600
TRAVEL_MAX_SECONDS = 21600
TRAVEL_MAX_SPEED_KMH = 900.0
BASELINE_DAYS = 7
BASELINE_MIN_HISTORY = 2
SPIKE_FACTOR = 3.0
DATA_FLOOR_MB = 500.0
STALE_DAYS = 45
MULTI_APP_MORE_THAN = 4
APPROVER_MIN_DECISIONS = 5
APPROVER_HIGH_RATE = 0.9
APPROVER_LOW_RATE = 0.1
CHURN_MIN_CHANGES = 4
CLEANEST_USERS = 10

# risk level thresholds, highest first: score >= threshold -> level
RISK_LEVELS = (("CRITICAL", 15), ("HIGH", 8), ("MEDIUM", 3))
RISK_LEVEL_DEFAULT = "LOW"

# risk factor -> weight
RISK_WEIGHTS = {
    "impossible_login": 3,
    "mfa_bypass": 5,
    "impossible_travel": 5,
    "shadow_access": 5,
    "privilege_escalation": 5,
    "rejected_but_executed": 5,
    "excessive_data": 3,
    "stale_access": 1,
    "orphan_event": 2,
    "orphan_user": 3,
    "time_warp": 4,
}
KNOWN_ANOMALY_FACTOR = "known_anomaly_label"
KNOWN_ANOMALY_WEIGHT = 1

# finding-id separator and identifier fallback
FINDING_ID_SEPARATOR = "||"
IDENTIFIER_FALLBACK = "manual"
IDENTIFIER_MAX_LENGTH = 63
# --- end of fixed values ----------------------------------------------------
