"""Message envelopes: one JSON record per source row plus routing columns.

`encode_records` turns source frames into envelopes (the publishing side);
`decode_envelopes` validates envelopes and splits them back into per-source
frames with lineage columns (the landing side). Both are plain projections,
so they run identically over a batch DataFrame or a streaming one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewatch.functions.columns import safe_identifier
from gatewatch.operators.scoring import union_all
from gatewatch.sources.contracts import KNOWN_SOURCES, SOURCE_REQUIRED_COLUMNS

ENVELOPE_COLUMNS = ("message_id", "value", "source", "pipeline_env", "run_id")
UNLABELLED_RUN = "unlabelled"


def encode_records(
    frames: Mapping[str, DataFrame], pipeline_env: str, run_id: str
) -> DataFrame:
    """Union of all sources as envelopes `(message_id, value, source,
    pipeline_env, run_id)`. `value` is compact JSON of the row's columns (the
    frame's own columns, in order); env and run id are normalised once. The
    message id is a content hash, so re-encoding the same row gives the same
    id (idempotent republish)."""
    parts = []
    for source, df in frames.items():
        if source not in KNOWN_SOURCES:
            raise ValueError(f"unknown source {source!r}")
        value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), {"ignoreNullFields": "false"})
        parts.append(
            df.select(
                value.alias("value"),
                F.lit(source).alias("source"),
                safe_identifier(F.lit(pipeline_env)).alias("pipeline_env"),
                safe_identifier(F.lit(run_id)).alias("run_id"),
            ).withColumn(
                "message_id", F.sha2(F.concat_ws("\u0001", "source", "run_id", "value"), 256)
            )
        )
    return union_all(parts).select(*ENVELOPE_COLUMNS)


def envelope_counts(envelopes: DataFrame) -> DataFrame:
    return envelopes.groupBy("source").agg(F.count(F.lit(1)).alias("messages"))


def observed_counts() -> list[Column]:
    """Messages per source, as metrics that a write can observe on the way."""
    return [F.count_if(F.col("source") == s).alias(s) for s in sorted(KNOWN_SOURCES)]


def rejection_reason(message_env: Column, expected_env: str) -> Column:
    """Why an envelope cannot be landed (null when it can)."""
    return F.when(~F.col("source").isin(*sorted(KNOWN_SOURCES)) | F.col("source").isNull(),
                  F.lit("unknown_source")).when(
        message_env != safe_identifier(F.lit(expected_env)), F.lit("environment_mismatch")
    )


def parse_envelopes(envelopes: DataFrame, expected_env: str) -> DataFrame:
    """Envelopes with `_run` (normalised run id), `_body` (the message body, parsed
    once, as a variant) and `_reason`, why the envelope cannot be landed (null when
    it can): unknown source, environment mismatch, or a body that is not a JSON
    object. A missing environment counts as the expected one; a missing run id
    becomes `unlabelled`; both are normalised like identifiers."""
    env = safe_identifier(F.coalesce(F.col("pipeline_env"), F.lit(expected_env)))
    run = safe_identifier(F.coalesce(F.col("run_id"), F.lit(UNLABELLED_RUN)))
    routed = envelopes.withColumns({"_env": env, "_run": run, "_route": rejection_reason(env, expected_env)})
    # a filter on a generator's output is not pushed below it, so that no reader of
    # these columns parses a second time
    parsed = routed.withColumn("_body", F.explode(F.array(F.when(F.col("_route").isNull(), F.try_parse_json("value")))))
    is_object = F.coalesce(F.schema_of_variant("_body").startswith("OBJECT"), F.lit(False))
    reason = F.coalesce("_route", F.when(~is_object, F.lit("bad_json")))
    return parsed.withColumn("_reason", F.explode(F.array(reason))).drop("_env", "_route")


def body_text(column: str) -> Column:
    """A field of the parsed body as text: strings as they are, other values as
    JSON writes them, null where it is missing."""
    return F.try_variant_get("_body", f"$.{column}", "string")


def source_rows(parsed: DataFrame, source: str, *, ingested_at: Column | None = None) -> DataFrame:
    """The landable rows of one source from `parse_envelopes`, with the lineage
    columns `_pipeline_run_id`, `_pubsub_message_id`, `_ingested_at` (ISO-8601 UTC
    text), and `_delivery` where the envelopes have it."""
    ingested = ingested_at if ingested_at is not None else F.date_format(
        F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    )
    # the order of delivery travels along where the envelopes carry it
    delivery = [F.col("_delivery")] if "_delivery" in parsed.columns else []
    return parsed.filter((F.col("source") == source) & F.col("_reason").isNull()).select(
        *[body_text(c).alias(c) for c in SOURCE_REQUIRED_COLUMNS[source]],
        F.col("_run").alias("_pipeline_run_id"),
        F.col("message_id").alias("_pubsub_message_id"),
        ingested.alias("_ingested_at"),
        *delivery,
    )


def rejected(parsed: DataFrame) -> DataFrame:
    """The envelopes that cannot be landed, with their `reason`."""
    return parsed.filter(F.col("_reason").isNotNull()).select(*ENVELOPE_COLUMNS, F.col("_reason").alias("reason"))


def decode_envelopes(
    envelopes: DataFrame,
    expected_env: str,
    *,
    ingested_at: Column | None = None,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Validate and decode envelopes: `(by_source, rejects)`.

    Rejects have a `reason` instead of failing the job (`require_clean` gives the
    fail-all behaviour). Every frame comes from one parsed frame; to read several
    of them, parse with `parse_envelopes`, persist that and take `source_rows` and
    `rejected` from it."""
    parsed = parse_envelopes(envelopes, expected_env)
    return {s: source_rows(parsed, s, ingested_at=ingested_at) for s in sorted(KNOWN_SOURCES)}, rejected(parsed)


def require_clean(rejects: DataFrame) -> None:
    """Fail-all mode: raise when any envelope was rejected."""
    first = rejects.limit(1).collect()
    if first:
        r = first[0]
        raise ValueError(f"Message {r['message_id']} rejected: {r['reason']} (source={r['source']!r})")
