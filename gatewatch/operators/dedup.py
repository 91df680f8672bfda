"""Deterministic one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per `keys` under `order` (give a total order: end
    with the remaining columns so the pick never depends on arrival).

    `row_number() = 1` is planned with a WindowGroupLimit on the map side of
    the shuffle, so a key with millions of copies is cut to one row per map
    task before anything is exchanged. Null keys form one group, like
    `dropDuplicates`.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
