"""Dimensions: seeds, loads, and the contract that every join with them relies on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.dedup import duplicate_keys

#: The seeds of the two coded dimensions, and the zones that stand for no place.
RATE_CODES = [(1, "Standard", False), (2, "JFK", True), (3, "Newark", True), (4, "Nassau or Westchester", False), (5, "Negotiated fare", False), (6, "Group ride", False)]
PAYMENT_TYPES = [(1, "Credit card", True), (2, "Cash", False), (3, "No charge", False), (4, "Dispute", False), (5, "Unknown", False), (6, "Voided trip", False)]
SENTINEL_ZONES = [264, 265]
MOST_AGE_DAYS = 90


def bounded(spark: SparkSession, rows: Sequence[tuple], **kinds: pa.DataType) -> DataFrame:
    """A few rows as a local relation, whose size the planner knows, so that it broadcasts it."""
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return spark.createDataFrame(pa.table({name: pa.array(values, kind) for (name, kind), values in zip(kinds.items(), columns, strict=True)}))


def rate_codes(spark: SparkSession) -> DataFrame:
    return bounded(spark, RATE_CODES, rate_code_id=pa.int32(), rate_code_name=pa.string(), is_flat_fare=pa.bool_())


def payment_types(spark: SparkSession) -> DataFrame:
    return bounded(spark, PAYMENT_TYPES, payment_type_id=pa.int32(), payment_type_name=pa.string(), tip_is_recorded=pa.bool_())


def zones(spark: SparkSession, csv: str) -> DataFrame:
    """The zone dimension from a CSV with a header."""
    raw = spark.read.option("header", True).schema("LocationID int, Borough string, Zone string, service_zone string").csv(csv)
    return raw.select(F.col("LocationID").alias("location_id"), F.col("Borough").alias("borough"), F.col("Zone").alias("zone"), "service_zone", F.col("LocationID").isin(*SENTINEL_ZONES).alias("is_sentinel"))


def stamped(dim: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """A dimension with the time of its load."""
    return dim.withColumn("_loaded_at", F.current_timestamp() if loaded_at is None else loaded_at)


def contract(dim: DataFrame, key: str, required: Sequence[str], now: Column, most_age_days: int = MOST_AGE_DAYS) -> DataFrame:
    """One row: what of the contract a dimension breaks (rows, missing, duplicate_keys, stale, from_the_future)."""
    empty = F.lit(False)
    for c in (key, *required):
        empty = empty | F.col(c).isNull()
    oldest = now - F.expr(f"INTERVAL {most_age_days} DAYS")
    facts = dim.agg(
        F.count("*").alias("rows"), F.count_if(empty).alias("missing"), F.count_if(F.col("_loaded_at") < oldest).alias("stale"), F.count_if(F.col("_loaded_at") > now).alias("from_the_future"),
    )
    doubles = duplicate_keys(dim, key).agg(F.count("*").alias("duplicate_keys"))
    return facts.withColumn("__one", F.lit(1)).join(doubles.withColumn("__one", F.lit(1)), "__one").drop("__one")


def validated(dim: DataFrame, key: str, required: Sequence[str] = (), most_age_days: int = MOST_AGE_DAYS) -> DataFrame:
    """The dimension, if it keeps the contract; else an error that says what it breaks."""
    if "_loaded_at" not in dim.columns:
        raise ValueError(f"{key}: the dimension has no load time")
    found = contract(dim, key, required, F.current_timestamp(), most_age_days).first().asDict()
    breaches = [name for name in ("missing", "duplicate_keys", "stale", "from_the_future") if found[name]] + ["empty"] * (not found["rows"])
    if breaches:
        raise ValueError(f"{key}: {', '.join(breaches)}")
    return dim


def load_time(year: int, month: int, day: int) -> Column:
    return F.lit(dt.datetime(year, month, day)).cast("timestamp")
