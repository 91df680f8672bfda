"""Bounded, restartable ingest of message envelopes into the landing zone.

Envelope files (JSON lines with `message_id, value, source, pipeline_env,
run_id`) are read as a stream; each micro-batch is decoded, validated and
landed (`sources.landing`), rejects go to `<landing>/_rejects`. A run pulls at
most `max_messages` messages (50,000) and stops, by the queue source of
`message_source`; with `max_messages=None` it drains what is there, file by file.

No message is dropped on its age: a file counts as delivered when the stream
reads it, whatever its modification time, and a redelivered message is the same
row again. The offsets are committed to the checkpoint only after the batch's
writes succeed, so a crash replays the batch; landing and loading both dedup by
identity and keep the last delivery, which makes replays and redeliveries
harmless (at-least-once delivery, exactly-once effect).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from gatewatch.sources.contracts import KNOWN_SOURCES
from gatewatch.sources.envelope import ENVELOPE_COLUMNS, parse_envelopes, rejected, source_rows
from gatewatch.sources.landing import land
from gatewatch.streaming.message_source import EnvelopeQueue

ENVELOPE_SCHEMA = StructType([StructField(c, StringType()) for c in ENVELOPE_COLUMNS])


def read_envelopes(spark: SparkSession, path: str, *, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.json(path)
    return source.select(
        *ENVELOPE_COLUMNS,
        F.col("_metadata.file_modification_time").alias("_arrival"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )


def pull_envelopes(spark: SparkSession, path: str, log: str, max_messages: int = 50_000) -> DataFrame:
    """The envelopes of a queue folder, at most `max_messages` a trigger, with
    `_delivery`, their order of delivery: pull, range of the pull, byte. A line
    that is no JSON object is an envelope of nulls."""
    spark.dataSource.register(EnvelopeQueue)
    lines = spark.readStream.format("envelope_queue").options(path=path, log=log, max_messages=max_messages).load()
    return lines.select(F.from_json("line", ENVELOPE_SCHEMA).alias("e"), F.struct("pull", "part", "at").alias("_delivery")).select(
        *[F.col(f"e.{c}").alias(c) for c in ENVELOPE_COLUMNS], "_delivery")


def with_delivery(batch: DataFrame) -> DataFrame:
    """Envelopes of one micro-batch with `_delivery`, their order of delivery:
    file time, file, place in the file."""
    return batch.select(
        *ENVELOPE_COLUMNS,
        F.struct("_arrival", "_file", "_block", F.monotonically_increasing_id().alias("_row")).alias("_delivery"),
    )


def ingest_stream(
    spark: SparkSession,
    envelope_path: str,
    landing_root: str,
    checkpoint: str,
    expected_env: str,
    *,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    max_messages: int | None = None,
) -> StreamingQuery:
    """Start the ingest query (call `.awaitTermination()` for a bounded run). With
    `max_messages` a trigger, and with `available_now` the run, pulls at most so
    many; the log of pulls is kept beside the checkpoint."""

    def land_batch(batch: DataFrame, batch_id: int) -> None:
        # read and parsed once: six sources and the rejects are written from the same rows
        parsed = parse_envelopes(batch if max_messages else with_delivery(batch), expected_env).persist()
        try:
            land({s: source_rows(parsed, s) for s in sorted(KNOWN_SOURCES)}, landing_root)
            rejected(parsed).withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(
                f"{landing_root.rstrip('/')}/_rejects"
            )
        finally:
            parsed.unpersist()

    if max_messages:
        stream = pull_envelopes(spark, envelope_path, f"{checkpoint.rstrip('/')}-pulls", max_messages)
    else:
        stream = read_envelopes(spark, envelope_path, max_files_per_trigger=max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def write_envelopes(envelopes: DataFrame, path: str) -> None:
    """Publish envelopes as JSON-lines files (the stream's input format)."""
    envelopes.select(*ENVELOPE_COLUMNS).write.mode("append").json(path)
