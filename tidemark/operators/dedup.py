"""One row for each key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in that order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


#: By which columns, where a frame has them, the newest delivery of a row is known.
RECENCY = ["_source_object_version", "_ingested_at", "_source_file"]


def latest_delivery(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest delivery of each key; trip_id decides where nothing says which is newer."""
    order = [F.col(c).desc_nulls_last() for c in RECENCY if c in df.columns] or [F.col("trip_id")]
    return first_by(df, keys, order)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that more than one row has, with how many."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
