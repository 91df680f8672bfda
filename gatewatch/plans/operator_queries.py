"""Registered queries exercising each generic operator on its own.

Every query reads whole driver tables (or the fixture sources derived from
them), so its work grows with the scale factor. Results are shaped like the
detections' (`comparable`): arrays and dates as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewatch.constants import COUNTRY_CENTROIDS, RISK_LEVEL_DEFAULT, RISK_LEVELS
from gatewatch.functions.columns import epoch_seconds, safe_identifier
from gatewatch.functions.findings import as_findings
from gatewatch.operators.aggregates import (
    conditional_rates,
    first_last_drift,
    inactivity,
    rolling_baseline,
    session_diversity,
)
from gatewatch.operators.dedup import latest_by_key
from gatewatch.operators.joins import interval_join, without_evidence
from gatewatch.operators.scan import asof_join, time_bucket
from gatewatch.operators.scoring import weighted_score
from gatewatch.operators.sequence import geo_velocity, match_sequence
from gatewatch.plans.queries import comparable
from gatewatch.sources.contracts import SOURCE_REQUIRED_COLUMNS, SOURCE_SCHEMAS
from gatewatch.sources.envelope import body_text, decode_envelopes, encode_records, parse_envelopes
from gatewatch.sources.fixtures import fixture_sources
from gatewatch.sources.loader import align, dedup_source

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dedup_latest_lineitem(spark, sf_dir):
    """Latest-per-key (landing and load dedup) on lineitem, whose
    (l_orderkey, l_linenumber) repeats: the greatest row under every other
    column, descending."""
    li = _t(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in li.columns if c not in keys]
    return latest_by_key(li, keys, [F.col(c).desc_nulls_last() for c in rest])


def asof_latest_login(spark, sf_dir):
    """Backward as-of: every app use with the user's latest login (any
    status) at or before it; ties on time go to the greater req_id."""
    src = fixture_sources(spark, sf_dir, links=False)
    app = src["app_usage"].select("usage_id", "user", F.col("ts").alias("app_ts"))
    logins = src["okta"].select("user", F.col("ts").alias("login_ts"), "req_id")
    out = asof_join(app, logins, ["user"], F.col("app_ts"), F.col("login_ts"),
                    F.struct("login_ts", "req_id"), bucket_of=lambda c: time_bucket(c, 3600),
                    out="hit")
    return out.select("usage_id", "user", "app_ts", F.col("hit.login_ts").alias("login_ts"),
                      F.col("hit.req_id").alias("login_req_id"))


def asof_next_use(spark, sf_dir):
    """Forward as-of: every login with the user's first app use at or after
    it; ties on time go to the smaller usage_id."""
    src = fixture_sources(spark, sf_dir, links=False)
    logins = src["okta"].select("req_id", "user", F.col("ts").alias("login_ts"))
    app = src["app_usage"].select("user", F.col("ts").alias("app_ts"), "usage_id")
    out = asof_join(logins, app, ["user"], F.col("login_ts"), F.col("app_ts"),
                    F.struct("app_ts", "usage_id"), bucket_of=lambda c: time_bucket(c, 3600),
                    direction="forward", out="hit")
    return out.select("req_id", "user", "login_ts", F.col("hit.app_ts").alias("app_ts"),
                      F.col("hit.usage_id").alias("next_usage_id"))


def interval_login_app_pairs(spark, sf_dir):
    """Interval join: every (login, later app use) of one user at most 600
    whole seconds apart."""
    src = fixture_sources(spark, sf_dir, links=False)
    logins = src["okta"].select("req_id", F.col("user").alias("login_user"), F.col("ts").alias("login_ts"))
    app = src["app_usage"].select("usage_id", "user", F.col("ts").alias("app_ts"))
    pairs = interval_join(logins, app, [("login_user", "user")], "login_ts", "app_ts", 600)
    return pairs.select("req_id", "usage_id", "user",
                        (epoch_seconds("app_ts") - epoch_seconds("login_ts")).alias("seconds_after"))


def unmatched_directory_requests(spark, sf_dir):
    """Anti join: directory events whose (request_id, user) has no request
    of any status."""
    src = fixture_sources(spark, sf_dir)
    reqs = src["saviynt"].select(F.col("req_id").alias("rid"), F.col("user").alias("ruser"))
    return without_evidence(src["ad"], reqs, [("request_id", "rid"), ("user", "ruser")], salt="event_id").select(
        "event_id", "user", "request_id", "action")


def rolling_daily_events(spark, sf_dir):
    """Rolling baseline: daily events per type with the mean and count of the
    7 previous calendar days."""
    ev = _t(spark, sf_dir, "events")
    daily = ev.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("events"))
    return comparable(rolling_baseline(daily, ["event_type"], "day", "events", days=7))


def event_sequences(spark, sf_dir):
    """Sequence match: the 'click' of every view -> click -> purchase run
    in a user's events ordered by (ts, event_id)."""
    ev = _t(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    hits = match_sequence(ev, ["user_id"], "ts", "event_id", "event_type", ["view", "click", "purchase"])
    return hits.select("event_id", "user_id", "ts")


def login_moves(spark, sf_dir):
    """Geo velocity over all logins (any status): every login with its
    previous one, the centroid distance and speed (null for unknown places)."""
    okta = fixture_sources(spark, sf_dir, links=False)["okta"].select("user", "req_id", "country", "ts")
    moves = geo_velocity(okta, ["user"], "ts", "req_id", "country", COUNTRY_CENTROIDS)
    return moves.select("req_id", "user", "previous_place", "seconds_between",
                        F.round("distance_km", 3).alias("distance_km"),
                        F.round("required_speed_kmh", 3).alias("required_speed_kmh"))


def order_priority_drift(spark, sf_dir):
    """First/latest order priority per customer by (date, order key)."""
    orders = _t(spark, sf_dir, "orders")
    return first_last_drift(orders, ["o_custkey"], "o_orderdate", "o_orderkey", "o_orderpriority",
                            first="first_priority", latest="latest_priority",
                            first_seen="first_order", last_seen="last_order",
                            distinct="distinct_priorities")


def supplier_line_rates(spark, sf_dir):
    """Conditional counts and a rate per supplier over all line items."""
    li = _t(spark, sf_dir, "lineitem")
    return conditional_rates(
        li, ["l_suppkey"],
        {"returned": F.col("l_returnflag") == "R", "open_lines": F.col("l_linestatus") == "O"},
        total="lines", extra={"last_ship": F.max("l_shipdate")},
        rates={"return_rate": ("returned", "lines")},
    )


def daily_event_variety(spark, sf_dir):
    """Set diversity: users with more than 3 event types in one day."""
    ev = _t(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return comparable(session_diversity(ev, ["user_id", "day"], "event_type", "ts", more_than=3,
                                        count_name="types", set_name="type_set",
                                        start="first_ts", end="last_ts"))


def customer_scores(spark, sf_dir):
    """Weighted score of every customer from counted order facts."""
    cust = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user"))
    orders = _t(spark, sf_dir, "orders").withColumn("user", F.col("o_custkey").cast("string"))
    contributions = [
        ("open_order", orders.filter(F.col("o_orderstatus") == "O"), 1),
        ("urgent_order", orders.filter(F.col("o_orderpriority") == "1-URGENT"), 3),
        ("large_order", orders.filter(F.col("o_totalprice") > 300000), 2),
    ]
    return comparable(weighted_score(cust, contributions, levels=RISK_LEVELS,
                                     default_level=RISK_LEVEL_DEFAULT))


def order_finding_ids(spark, sf_dir):
    """Finding metadata (deterministic sha2 ids, event dates) over orders."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return comparable(as_findings(orders, "order_check", ("o_orderkey", "o_orderstatus"),
                                  "o_orderdate", "fixture-run", with_detected_at=False))


def page_identifiers(spark, sf_dir):
    """Identifier normalisation over every page URL."""
    pages = _t(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", safe_identifier("url").alias("identifier"))


def envelope_round_trip(spark, sf_dir):
    """Encode the login source as JSON envelopes, decode and validate them
    again: the business columns come back unchanged."""
    okta = fixture_sources(spark, sf_dir, links=False)["okta"].withColumn("ts", F.date_format("ts", TS_TEXT))
    by_source, _ = decode_envelopes(encode_records({"okta": okta}, "dev", "fixture run"), "dev")
    cols = [c for c in SOURCE_REQUIRED_COLUMNS["okta"] if c in okta.columns]
    return by_source["okta"].select(*cols, "_pipeline_run_id")


def _as_text(df: DataFrame) -> DataFrame:
    """All columns as landed text; times in one fixed format."""
    return df.select(*[
        (F.date_format(f.name, TS_TEXT) if f.dataType.typeName().startswith("timestamp") else F.col(f.name).cast("string")).alias(f.name)
        for f in df.schema.fields
    ])


def landed_latest(spark, sf_dir):
    """Publish, decode, landing dedup: every app use delivered twice, the second
    time with a blank session; the last delivery is the one that stays."""
    uses = _as_text(fixture_sources(spark, sf_dir, links=False)["app_usage"].drop("request_id", "data_mb"))
    again = uses.withColumn("session_id", F.lit(""))
    sent = encode_records({"app_usage": uses}, "dev", "run 1").withColumn("_delivery", F.lit(1)).unionByName(
        encode_records({"app_usage": again}, "dev", "run 2").withColumn("_delivery", F.lit(2)))
    decoded, _ = decode_envelopes(sent, "dev", ingested_at=F.lit("2026-01-01T00:00:00Z"))
    kept = dedup_source(decoded["app_usage"], "app_usage")
    return kept.select("usage_id", "user", "ts", "app", "action", "session_id", "_pipeline_run_id")


def envelope_counts_by_source(spark, sf_dir):
    """All six sources as envelopes and back: rows and blanks per source, and
    no rejects."""
    frames = {s: _as_text(df) for s, df in fixture_sources(spark, sf_dir, links=False).items()}
    parsed = parse_envelopes(encode_records(frames, "dev", "all"), "dev")
    label = F.when(F.col("_reason").isNotNull(), F.lit("rejects")).otherwise(F.col("source"))
    blank = label.isin("okta", "app_usage") & (body_text("session_id") == "")
    counts = parsed.groupBy(label.alias("source")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(blank).alias("n_blank"))
    every = spark.createDataFrame([(s,) for s in (*sorted(frames), "rejects")], "source string")
    none = F.lit(0).cast("long")
    return every.join(counts, "source", "left").select(
        "source", F.coalesce("n_rows", none).alias("n_rows"), F.coalesce("n_blank", none).alias("n_blank"))


def inactive_buyers(spark, sf_dir):
    """Inactivity: users whose latest purchase was followed by no click for more
    than 3 days before the latest click of anyone."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    bought = ev.filter("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("bought"))
    clicks = ev.filter("event_type = 'click'")
    out = inactivity(bought, clicks, ["user_id"], granted="bought", used="ts", days=3)
    return out.select("user_id", F.date_format("bought", TS_TEXT).alias("bought"),
                      F.date_format("last_used_time", TS_TEXT).alias("last_click"), F.col("inactive_days").cast("int").alias("inactive_days"))


def aligned_logins(spark, sf_dir):
    """Schema alignment of the login source onto its landed contract: all
    columns as text, contract columns missing from the frame as nulls."""
    okta = fixture_sources(spark, sf_dir, links=False)["okta"].withColumn("ts", F.date_format("ts", TS_TEXT))
    return align(okta, SOURCE_SCHEMAS["okta"])


OPERATOR_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        dedup_latest_lineitem, asof_latest_login, asof_next_use, interval_login_app_pairs,
        unmatched_directory_requests, rolling_daily_events, event_sequences, login_moves,
        order_priority_drift, supplier_line_rates, daily_event_variety, customer_scores,
        order_finding_ids, page_identifiers, envelope_round_trip, aligned_logins, landed_latest,
        envelope_counts_by_source, inactive_buyers,
    ]
}
