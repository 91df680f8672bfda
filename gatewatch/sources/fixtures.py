"""Identity sources derived from the driver's test tables.

Each view is written once as SQL text with `{table}` placeholders. Spark runs
it through `spark.sql(text, name=DataFrame)`; the DuckDB oracle gets the same
text as a WITH clause. The one exception is `linked` on the Spark side,
built with a skew-safe two-level scan (`linked_events`) rather than a window over
each user's full history. The derived sources grow with `events`,
`customer` and `labels`, and every query reads them in full.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ("events", "customer", "labels")

_S = "CAST({x} AS VARCHAR(20))"


def _s(x: str) -> str:
    return _S.format(x=x)


_USER = f"concat('user', {_s('user_id')})"
_SESSION = (
    "CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 11 = 1 THEN NULL "
    f"ELSE concat('S', {_s('user_id')}, '-', {_s('CAST(floor(extract(day FROM ts) / 7) AS INT)')}) END"
)
_APP = (
    "CASE k % 5 WHEN 0 THEN 'GitHub' WHEN 1 THEN 'Snowflake' WHEN 2 THEN 'Databricks' "
    "WHEN 3 THEN 'Workday' ELSE 'Salesforce' END"
)
_K = "CAST(regexp_extract(props, '[0-9]+', 0) AS INT)"
_REQUEST_ROW = "event_type = 'purchase' AND event_id % 2 = 0"

# events plus k, and per user (ordered by ts, event_id) the largest request id
# strictly before the row and the smallest request id strictly after it.
LINKED = f"""
SELECT e.*,
  max(CASE WHEN {_REQUEST_ROW} THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prv,
  min(CASE WHEN {_REQUEST_ROW} THEN event_id END) OVER (PARTITION BY user_id ORDER BY ts, event_id
      ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
FROM (SELECT *, {_K} AS k FROM {{events}}) e
"""

AUTH = f"""
SELECT concat('L', {_s('event_id')}) AS req_id,
  {_USER} AS user_name,
  ts,
  CASE event_id % 9 WHEN 0 THEN 'USA' WHEN 1 THEN 'UK' WHEN 2 THEN 'India' WHEN 3 THEN 'Japan'
    WHEN 4 THEN 'Brazil' WHEN 5 THEN 'Singapore' WHEN 6 THEN 'Germany' WHEN 7 THEN 'Australia'
    ELSE 'Atlantis' END AS country,
  CASE k % 3 WHEN 0 THEN 'push' WHEN 1 THEN 'sms' ELSE 'totp' END AS mfa,
  CASE WHEN event_type = 'signup' THEN ' success ' WHEN k % 2 = 0 THEN 'FAILED' ELSE 'mfa_failed' END
    AS status,
  {_SESSION} AS session_id
FROM (SELECT *, {_K} AS k FROM {{events}}) e
WHERE event_type IN ('signup', 'error')
"""

APP = f"""
SELECT concat('U', {_s('event_id')}) AS usage_id,
  {_USER} AS user_name,
  ts,
  {_APP} AS app,
  event_type AS action,
  value * 20 AS data_mb,
  {_SESSION} AS session_id,
  CASE WHEN event_id % 6 = 0 AND nxt IS NOT NULL THEN concat('R', {_s('nxt')})
       WHEN event_id % 6 = 1 AND prv IS NOT NULL THEN concat('R', {_s('prv')}) END AS request_id
FROM {{linked}}
WHERE event_type IN ('click', 'view')
"""

REQ = f"""
SELECT concat('R', {_s('event_id')}) AS req_id,
  {_USER} AS user_name,
  CASE WHEN event_id % 8 = 0 THEN ts - INTERVAL '60' DAY ELSE ts END AS ts,
  {_APP} AS app,
  CASE k % 4 WHEN 0 THEN 'admin' WHEN 1 THEN 'editor' ELSE 'viewer' END AS role,
  CASE WHEN k % 20 = 0 THEN 'APPROVED' WHEN k % 20 = 1 THEN 'denied'
       WHEN event_id % 8 = 0 THEN 'completed ' WHEN event_id % 8 = 2 THEN 'REJECTED'
       WHEN event_id % 8 = 4 THEN 'APPROVED' ELSE 'PENDING' END AS status,
  concat('mgr', {_s('k % 20')}) AS approver
FROM (SELECT *, {_K} AS k FROM {{events}}) e
WHERE {_REQUEST_ROW}
"""

DIR = f"""
SELECT concat('D', {_s('event_id')}) AS event_id,
  {_USER} AS user_name,
  ts,
  CASE (user_id + event_id % 4) % 6 WHEN 0 THEN 'DBA' WHEN 1 THEN 'DevOps'
    WHEN 2 THEN 'Security-Admins' WHEN 3 THEN 'HR' WHEN 4 THEN 'Finance' ELSE 'Contractor' END
    AS group_name,
  CASE WHEN k % 3 = 0 THEN 'add_member' WHEN k % 3 = 1 THEN 'remove_member'
    WHEN extract(day FROM ts) = 15 OR k % 15 = 2 THEN 'privilege_escalation' ELSE 'add_member' END
    AS action,
  'svc' AS initiator,
  CASE WHEN k % 4 = 0 AND nxt IS NOT NULL THEN concat('R', {_s('nxt')})
       WHEN k % 4 < 3 AND prv IS NOT NULL THEN concat('R', {_s('prv')}) END AS request_id
FROM {{linked}}
WHERE event_type = 'purchase' AND event_id % 2 = 1
"""

HR = f"""
SELECT concat('user', {_s('c_custkey')}) AS user_name FROM {{customer}} WHERE c_custkey % 10 <> 7
"""

KNOWN = f"""
SELECT concat('user', {_s('doc_id % (SELECT count(*) FROM {customer})')}) AS user_name,
  concat('toxic ', {_s('doc_id')}) AS anomaly_description
FROM {{labels}} WHERE toxic = 1
"""

# view name -> (sql, source name in the engine)
VIEWS: dict[str, tuple[str, str | None]] = {
    "linked": (LINKED, None),
    "auth": (AUTH, "okta"),
    "app": (APP, "app_usage"),
    "req": (REQ, "saviynt"),
    "dir": (DIR, "ad"),
    "hr": (HR, "hrlifecycle"),
    "known": (KNOWN, "anomaly_key"),
}


def duckdb_with_clause() -> str:
    """All fixture views as one `WITH` prefix for DuckDB (no trailing comma)."""
    names = {v: v for v in VIEWS} | {t: t for t in BASE_TABLES}
    parts = [f"{name} AS ({sql.format(**names).strip()})" for name, (sql, _) in VIEWS.items()]
    return "WITH " + ",\n".join(parts)


def linked_events(events: DataFrame, bucket_seconds: int = 6 * 3600) -> DataFrame:
    """`LINKED` as DataFrame operations: the per-user request ids before and
    after each event come from a two-level scan over (user, time bucket)
    chunks (`running_extremes`) instead of one window over each user's whole
    history, so a user with a large share of all events does not end up in
    one task. Same rows as the SQL text (checked in tests)."""
    from pyspark.sql import functions as F

    from gatewatch.operators.scan import running_extremes, time_bucket

    ev = events.withColumn("k", F.expr(_K))
    request_id = F.when(F.expr(_REQUEST_ROW), F.col("event_id"))
    return running_extremes(
        ev, ["user_id"], [F.col("ts"), F.col("event_id")], request_id,
        bucket=time_bucket(F.col("ts"), bucket_seconds), before="prv", after="nxt",
    )


def _rename(df: DataFrame) -> DataFrame:
    renames = {"user_name": "user", "group_name": "group"}
    return df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})


class FixtureFrames(Mapping):
    """Canonical source frames by name, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, *, links: bool = True, base: dict[str, DataFrame] | None = None) -> None:
        self.spark, self.links = spark, links
        self.root = sf_dir.rstrip("/")
        self.base: dict[str, DataFrame] = {} if base is None else base
        self.views: dict[str, DataFrame] = {}
        self.names = {source: view for view, (_, source) in VIEWS.items() if source is not None}

    def _view(self, name: str) -> DataFrame:
        from pyspark.sql import functions as F

        if name in BASE_TABLES:
            if name not in self.base:
                self.base[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
            return self.base[name]
        if name not in self.views:
            sql, _ = VIEWS[name]
            if name != "linked":
                self.views[name] = self.spark.sql(sql, **{k: self._view(k) for k in (*BASE_TABLES, *VIEWS) if "{" + k + "}" in sql})
            elif self.links:
                self.views[name] = linked_events(self._view("events"))
            else:
                none = F.lit(None).cast("long")
                self.views[name] = self._view("events").withColumns({"k": F.expr(_K), "prv": none, "nxt": none})
        return self.views[name]

    def without_links(self) -> FixtureFrames:
        return FixtureFrames(self.spark, self.root, links=False, base=self.base)

    def __getitem__(self, source: str) -> DataFrame:
        return _rename(self._view(self.names[source]))

    def __iter__(self) -> Iterator[str]:
        return iter(self.names)

    def __len__(self) -> int:
        return len(self.names)


def fixture_sources(spark: SparkSession, sf_dir: str, *, links: bool = True) -> FixtureFrames:
    """Canonical source frames (engine column names) derived from `sf_dir`.

    `links=False` leaves every request id of directory and app rows null and
    with it the scan over each user's requests, for queries that do not read
    them."""
    return FixtureFrames(spark, sf_dir, links=links)
