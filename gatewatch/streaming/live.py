"""Detections over unbounded sources (Structured Streaming).

| rule | streaming form |
| --- | --- |
| D2 mfa bypass | stream-stream inner join, watermarks on both sides, time range |
| D16 orphan events | stream-static left anti join against the workforce table |
| D12 multi-app session | event-time session window per (user, session) |
| D1 path B | logins and uses of a user in time order, the last login held |
| D4 travel, D8 sequence | rows in time order per key and time bucket (`ordered`) |
| D5, D19 evidence | `foreachBatch` anti join against the requests table |
| D6, D9 baselines | a store of daily totals (`daily_store`); days whose result can |
|                  | have changed re-scored by `foreachBatch` |

Every rule takes an event once, however often it is delivered. D6 and D9 tell
events apart by their identity within the day, at any age. The other rules take
the first delivery (`first_deliveries`): identities are held for `delay` behind the
latest event, and what comes later than that is late.

Timestamps must be TIMESTAMP (not NTZ) for watermarks. Late rows are left out;
`dropped_by_watermark` counts them, and the batch rules over the landed tables
(`plans.runner`) correct for them. D6 and D9 drop nothing. D1, D4 and D8 need the
RocksDB state store (`session.ENGINE_CONF`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from gatewatch import constants as K
from gatewatch.functions.columns import blank, epoch_seconds, nonblank, normalized_status, session_key
from gatewatch.operators.aggregates import rolling_baseline
from gatewatch.operators.sequence import place_distance_km
from gatewatch.plans import rules as R
from gatewatch.sources.contracts import SOURCE_ID_COLUMNS
from gatewatch.streaming.daily_store import DAY, DailyStore
from gatewatch.streaming.ordered import OrderedRows, ordered_columns, scan_in_order, split_by_time


def first_deliveries(events: DataFrame, source: str, delay: str = "2 hours") -> DataFrame:
    """The events of a source stream, each once: deliveries of an identity after
    the first are left out. State holds the identities of the last `delay`; a
    redelivery from before that is late, so it does not come through either."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(list(SOURCE_ID_COLUMNS[source]))


def dropped_by_watermark(query: StreamingQuery) -> int:
    """Rows that the query's stateful operators left out as too late, over the
    progress reports that Spark keeps."""
    return sum(
        int(op.get("numRowsDroppedByWatermark", 0)) for p in map(dict, query.recentProgress) for op in p["stateOperators"])


# ---------------------------------------------------------------- D2


def mfa_bypass_stream(
    okta: DataFrame,
    app: DataFrame,
    *,
    delay: str = "2 hours",
    within_seconds: int = K.FAILURE_TO_APP_MAX_SECONDS,
) -> DataFrame:
    """Failed login x later app use of the same user within the window; Spark
    keeps each side's rows in state only until the other side's watermark
    passes their window, so state is bounded by the delay and the window."""
    failed = first_deliveries(okta.filter(normalized_status("status").contains(K.FAILURE_MARKER)), "okta", delay).select(
        F.col("req_id").alias("failed_request_id"), F.col("user").alias("failed_user"),
        F.col("session_id").alias("failed_session_id"), F.col("status").alias("failure_status"),
        F.col("ts").alias("failure_ts"),
    )
    used = first_deliveries(app, "app_usage", delay).select(
        "user", "usage_id", F.col("session_id").alias("app_session_id"), "app",
        F.col("ts").alias("app_ts"),
    )
    cond = (
        (F.col("user") == F.col("failed_user"))
        & (F.col("app_ts") > F.col("failure_ts"))
        & (F.col("app_ts") <= F.col("failure_ts") + F.expr(f"INTERVAL {within_seconds + 1} SECONDS"))
        & (epoch_seconds("app_ts") - epoch_seconds("failure_ts") <= within_seconds)
        & (blank("failed_session_id") | blank("app_session_id")
           | (F.col("app_session_id") == F.col("failed_session_id")))
    )
    return used.join(failed, cond, "inner").select(
        "user", "failed_request_id", "usage_id", "failed_session_id", "app_session_id",
        "failure_status", F.col("failure_ts").alias("mfa_failure_time"), "app",
        F.col("app_ts").alias("app_access_time"),
        (epoch_seconds("app_ts") - epoch_seconds("failure_ts")).alias("seconds_after_failure"),
    )


# ---------------------------------------------------------------- D16


def orphan_events_stream(events: DataFrame, hr: DataFrame) -> DataFrame:
    """`events` is a stream of (user, source_event_id, source, event_time);
    `hr` a static table, re-read by Spark for every micro-batch."""
    return R.orphan_events(events, hr)


def source_events_stream(okta: DataFrame, saviynt: DataFrame, ad: DataFrame, app: DataFrame, *, delay: str = "2 hours") -> DataFrame:
    """Events of the four source streams, each once."""
    return R.source_events(*(first_deliveries(df, source, delay) for df, source in (
        (okta, "okta"), (saviynt, "saviynt"), (ad, "ad"), (app, "app_usage"))))


# ---------------------------------------------------------------- D12


def multi_app_session_stream(
    app: DataFrame, *, gap: str = "1 day", delay: str = "1 hour",
    more_than: int = K.MULTI_APP_MORE_THAN,
) -> DataFrame:
    """Distinct apps per (user, session). A session's uses belong together
    while they are at most `gap` apart, whatever day boundary lies between
    (append mode emits a session once the watermark is `gap` past its end)."""
    return (
        first_deliveries(app.filter(nonblank("session_id")), "app_usage", delay)
        .groupBy("user", "session_id", F.session_window("ts", gap).alias("w"))
        .agg(
            F.sort_array(F.collect_set("app")).alias("applications"),
            F.min("ts").alias("session_start"),
            F.max("ts").alias("session_end"),
        )
        .withColumn("application_count", F.size("applications").cast("long"))
        .filter(F.col("application_count") > more_than)
        .select("user", "session_id", "application_count", "applications", "session_start", "session_end")
    )


# ---------------------------------------------------------------- D1 path B


def no_recent_login_stream(
    okta: DataFrame, app: DataFrame, *, delay: str = "1 hour",
    max_seconds: int = K.LOGIN_TO_APP_MAX_SECONDS, tick_seconds: int = 300,
) -> DataFrame:
    """App use without a session whose user has no successful login at or before
    it, or whose last one is over `max_seconds` before: the batch rule's two
    reasons with the login time. Logins and uses are one stream in time order per
    user; a user's state is the rows newer than the watermark and the last login,
    which is held for good (one row per user)."""
    timed = F.col("user").isNotNull() & F.col("ts").isNotNull()
    logins = first_deliveries(okta.filter((normalized_status("status") == K.SUCCESS_STATUS) & timed), "okta", delay).select(
        "user", *ordered_columns("ts", "req_id", F.lit(0)), F.lit("login").alias("kind"),
        F.lit(None).cast("string").alias("session_id"), F.lit(None).cast("string").alias("app"), "ts")
    uses = first_deliveries(app.filter(blank("session_id") & F.col("ts").isNotNull()), "app_usage", delay).select(
        "user", *ordered_columns("ts", "usage_id", F.lit(1)), F.lit("use").alias("kind"), "session_id", "app", "ts")

    def step(key: tuple, before: list[tuple], row: tuple) -> tuple | None:
        at, _, usage_id, kind, session_id, app_ = row
        last = before[-1][0] if before else None
        if kind != "use" or (last is not None and at // 1_000_000 - last // 1_000_000 <= max_seconds):
            return None
        return (key[0], usage_id, session_id, app_, last, at)

    found = scan_in_order(
        logins.unionByName(uses), ["user"],
        OrderedRows(("kind", "session_id", "app"), step, ("user", "usage_id", "session_id", "app", "login_at", "use_at"),
                    keeps=lambda row: row[3] == "login", tick_seconds=tick_seconds),
        "user string, usage_id string, session_id string, app string, login_at long, use_at long")
    found = found.withColumns({"login_time": F.timestamp_micros("login_at"), "app_access_time": F.timestamp_micros("use_at")})
    return found.select(
        "user", "usage_id", "session_id", "app", "login_time", "app_access_time",
        (epoch_seconds("app_access_time") - epoch_seconds("login_time")).alias("seconds_from_login"),
        F.when(F.col("login_time").isNull(), F.lit("no_preceding_login"))
        .otherwise(F.lit("application_too_long_after_login")).alias("anomaly_reason"))


def no_recent_login_batch_writer(okta_loader, sink):
    """`foreachBatch` function over session-less app uses: the batch rule's two
    reasons with the login time, against the logins as they are when the batch
    runs (`okta_loader()` returns them). `sink(df, batch_id)` persists."""

    def run(batch: DataFrame, batch_id: int) -> None:
        sink(R.impossible_login(okta_loader(), batch.filter(blank("session_id"))), batch_id)

    return run


# ---------------------------------------------------------------- D4, D8


def impossible_travel_stream(
    okta: DataFrame, *, delay: str = "2 hours", max_seconds: int = K.TRAVEL_MAX_SECONDS,
    max_speed_kmh: float = K.TRAVEL_MAX_SPEED_KMH, tick_seconds: int = 300,
) -> DataFrame:
    """D4 per user and time bucket of `max_seconds`: logins further apart are no
    finding, so a bucket needs the last login before it and no more."""
    logins = first_deliveries(
        okta.filter(normalized_status("status") == K.SUCCESS_STATUS).filter(F.col("ts").isNotNull()), "okta", delay,
    ).select("user", *ordered_columns("ts", "req_id"), "country", "ts")

    def step(key: tuple, before: list[tuple], row: tuple) -> tuple | None:
        if not before or before[-1][3] is None or row[3] is None or row[3] == before[-1][3]:
            return None
        if not 0 < row[0] // 1_000_000 - before[-1][0] // 1_000_000 <= max_seconds:
            return None
        return (key[0], row[2], before[-1][3], row[3], before[-1][0], row[0])

    moves = scan_in_order(
        split_by_time(logins, max_seconds + 1, 1), ["user", "bucket"],
        OrderedRows(("country",), step, ("user", "req_id", "previous_country", "current_country", "previous_at", "current_at"),
                    tick_seconds=tick_seconds, bucket_seconds=max_seconds + 1),
        "user string, req_id string, previous_country string, current_country string, previous_at long, current_at long")
    seconds = F.floor(F.col("current_at") / 1_000_000) - F.floor(F.col("previous_at") / 1_000_000)
    km = place_distance_km("previous_country", "current_country", K.COUNTRY_CENTROIDS)
    return (
        moves.withColumns({"seconds_between": seconds.cast("long"), "_km": km})
        .withColumn("_speed", F.col("_km") / (F.col("seconds_between") / F.lit(3600.0)))
        .filter(F.col("_speed") > max_speed_kmh)
        .select("user", "req_id", "previous_country", "current_country",
                F.timestamp_micros("previous_at").alias("previous_login_ts"), F.timestamp_micros("current_at").alias("current_login_ts"),
                "seconds_between", F.round("_km", 1).alias("distance_km"), F.round("_speed", 1).alias("required_speed_kmh"))
    )


def high_risk_sequence_stream(
    app: DataFrame, *, delay: str = "2 hours", idle_seconds: int = 30 * 86400, tick_seconds: int = 300,
) -> DataFrame:
    """D8 per session and time bucket of `idle_seconds`: after a pause as long as
    that a session begins anew, so a bucket needs the last two uses before it. A
    shorter pause splits a hot session (the stand-in of a user without sessions)
    further."""
    first, middle, last = K.HIGH_RISK_SEQUENCE
    uses = first_deliveries(app.filter(F.col("ts").isNotNull()), "app_usage", delay).withColumn(
        "session_key", session_key()).select("user", "session_key", *ordered_columns("ts", "usage_id"), "app", "session_id", "ts")

    def step(key: tuple, before: list[tuple], row: tuple) -> tuple | None:
        if len(before) < 2 or (before[0][3], before[1][3], row[3]) != (first, middle, last):
            return None
        if max(before[1][0] - before[0][0], row[0] - before[1][0]) > idle_seconds * 1_000_000:
            return None
        return (key[0], before[1][2], before[1][4], first, middle, last, before[1][0])

    found = scan_in_order(
        split_by_time(uses, idle_seconds, 2), ["user", "session_key", "bucket"],
        OrderedRows(("app", "session_id"), step, ("user", "usage_id", "session_id", "previous_app", "current_app", "next_app", "at"),
                    carry=2, tick_seconds=tick_seconds, bucket_seconds=idle_seconds),
        "user string, usage_id string, session_id string, previous_app string, current_app string, next_app string, at long")
    return found.withColumn("sequence_time", F.timestamp_micros("at")).drop("at")


# ---------------------------------------------------------------- D5, D19


def evidence_batch_writer(saviynt_loader, sink):
    """`foreachBatch` function: per micro-batch of directory events, the
    shadow-access and escalation findings against the requests table as it
    is when the batch runs (`saviynt_loader()` returns it). `sink(name, df,
    batch_id)` persists each result. Stream-stream anti joins are not
    supported, and absence can only be decided against a table anyway."""

    def run(batch: DataFrame, batch_id: int) -> None:
        requests = saviynt_loader()
        sink("shadow_access_events", R.shadow_access(batch, requests), batch_id)
        sink("privilege_escalation_without_request",
             R.privilege_escalation_without_request(batch, requests), batch_id)

    return run


def evidence_stream(ad: DataFrame, saviynt_loader: Callable[[], DataFrame], sink, *, delay: str = "2 hours") -> DataStreamWriter:
    """`evidence_batch_writer` over the directory events of a stream, each once."""
    return first_deliveries(ad, "ad", delay).writeStream.foreachBatch(evidence_batch_writer(saviynt_loader, sink))


# ---------------------------------------------------------------- D6, D9 over stored daily totals


def baseline_batch_writer(history_path: str, scored_path: str, kind: str, *,
                          days: int = K.BASELINE_DAYS, max_parts: int = 24):
    """`foreachBatch` function over app uses (kind="data", D9) or directory
    changes (kind="volume", D6).

    Each micro-batch goes into a `DailyStore`, which keeps every event once and
    replaces the totals of the days it touched. Days whose result can have changed,
    the touched days and the `days` after each, are re-scored from the totals and
    replaced in the scored table. Every scored (key, day) row is kept with an
    `is_finding` flag, so a day that stops being a finding is overwritten too. Only
    dates reach the driver.
    """
    import datetime as dt

    if kind == "data":
        value, key, average, source = "total_data_mb", "user", "rolling_average_mb", "app_usage"
        amount = F.col("data_mb").try_cast("double")
    elif kind == "volume":
        value, key, average, source = "event_count", "action", "rolling_average", "ad"
        amount = F.lit(1).cast("long")
    else:
        raise ValueError("kind must be 'data' or 'volume'")
    store = DailyStore(history_path, SOURCE_ID_COLUMNS[source], key, amount, value, max_parts)

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        touched = store.add(batch, batch_id)
        if not touched:
            return
        after = {d + dt.timedelta(days=k) for d in touched for k in range(days + 1)}
        before = {d - dt.timedelta(days=k) for d in after for k in range(days + 1)}
        scored = rolling_baseline(store.totals(spark, sorted(before)), [key], DAY, value, days=days, average=average)
        if kind == "data":
            hit = F.col(value) > F.greatest(F.col(average) * K.SPIKE_FACTOR, F.lit(K.DATA_FLOOR_MB))
        else:
            hit = F.col(value) > F.col(average) * K.SPIKE_FACTOR
        flag = F.coalesce((F.col("history_days") >= K.BASELINE_MIN_HISTORY) & hit, F.lit(False))
        (scored.filter(F.col(DAY).isin(sorted(after)))
         .withColumn("is_finding", flag)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(DAY).parquet(scored_path))

    return run
