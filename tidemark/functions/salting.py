"""Two-phase aggregation for keys that a few groups dominate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT_BUCKETS = 8


def salt_of(*columns: Column, buckets: int = SALT_BUCKETS) -> Column:
    """A salt that is the same each time a row is read."""
    return F.pmod(F.hash(*columns), F.lit(buckets))


def salted_count(df: DataFrame, keys: Sequence[str], salt_by: Column, *, buckets: int = SALT_BUCKETS, name: str = "n") -> DataFrame:
    """Rows for each key: counted by key and salt, then summed."""
    partial = df.withColumn("__salt", salt_of(salt_by, buckets=buckets)).groupBy(*keys, "__salt").agg(F.count("*").alias("__n"))
    return partial.groupBy(*keys).agg(F.sum("__n").alias(name))
