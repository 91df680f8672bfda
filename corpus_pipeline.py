"""The corpus pipeline: documents in, packed training sequences out.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all rows its
predecessor kept; all but the last return the columns of ``documents``. Null
texts pass the filters as empty ones, rows with a null id are judged like any
other (only the near-duplicate stage keeps them all), other columns travel
along, and an empty table stays empty."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatewatch.llm.common import checkpointed, table
from gatewatch.llm.decontaminate import drop_contaminated
from gatewatch.llm.packing import pack_documents
from gatewatch.llm.pii import redact
from gatewatch.llm.simhash import keep_one_per_group
from gatewatch.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more go; the model learns from ``labels``."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash group (3-word shingles, at most 2 bits) the document with
    the smallest id stays."""
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of ``benchmark`` go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts gives way to its kind in brackets."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their ids, packed into sequences of 2048 ids."""
    return pack_documents(docs, with_ids=True).withColumnRenamed("id", "doc_id")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# Learnt scores, similarity groups and packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Each result is written to the checkpoint
    folder and read again, so the next stage starts from files."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = checkpointed(docs)
    return docs
