"""From raw batch to clean and quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import month_of
from tidemark.functions.identity import with_identities
from tidemark.functions.rules import Lookup, flag_unresolved
from tidemark.functions.trips import CLEAN_NAMES, LINEAGE, MONEY, validity_rules
from tidemark.operators.dedup import latest_delivery


def trip_lookups(zones: DataFrame, rate_codes: DataFrame, payment_types: DataFrame) -> list[Lookup]:
    return [
        Lookup(zones, "location_id", ["PULocationID", "DOLocationID"], "UNKNOWN_ZONE", "is_sentinel", "SENTINEL_ZONE"),
        Lookup(rate_codes, "rate_code_id", ["RatecodeID"], "UNKNOWN_RATE_CODE"),
        Lookup(payment_types, "payment_type_id", ["payment_type"], "UNKNOWN_PAYMENT_TYPE"),
    ]


def classify(batch: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """The batch with identities and, where a row is not valid, its reason_code."""
    identified = with_identities(batch)
    return flag_unresolved(identified.withColumn("reason_code", validity_rules(identified).reason()), lookups)


def clean(valid: DataFrame) -> DataFrame:
    """Valid rows under their clean names, money as decimals, times without zone, and the month of the pickup."""
    renamed = [F.col(raw).alias(name) for raw, name in CLEAN_NAMES.items() if raw in valid.columns]
    out = valid.select("trip_id", *renamed, *(c for c in LINEAGE if c in valid.columns))
    kinds = dict.fromkeys(MONEY, "decimal(10,2)") | {"pickup_at": "timestamp_ntz", "dropoff_at": "timestamp_ntz"}
    out = out.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items() if c in out.columns})
    return out.withColumn("pickup_month", month_of(F.col("pickup_at"))) if "pickup_at" in out.columns else out


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and others, each of them once."""
    valid = latest_delivery(checked.filter(F.col("reason_code").isNull()).drop("reason_code"), ["trip_id"])
    others = latest_delivery(checked.filter(F.col("reason_code").isNotNull()), ["trip_id", "reason_code"])
    return valid, others


def process(batch: DataFrame, lookups: Sequence[Lookup], quarantined_at=None) -> tuple[DataFrame, DataFrame]:
    """Clean rows, and quarantined rows with their raw names and reason."""
    valid, others = split(classify(batch, lookups))
    return clean(valid), others.withColumn("quarantined_at", F.current_timestamp() if quarantined_at is None else quarantined_at)


def touched_months(silver: DataFrame) -> DataFrame:
    return silver.select("pickup_month").distinct()


def metrics(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row counts of a classified batch in one pass: what came in, stays, is quarantined, and was a repetition."""
    good, n = F.col("reason_code").isNull(), F.col("__n")
    # each row once, with how often it came: one shuffle, where two distinct counts would multiply the rows first
    once = checked.groupBy(*by, "trip_id", "reason_code").agg(F.count("*").alias("__n"))
    facts = once.groupBy(*by).agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("rows_in"), F.count_if(good).alias("rows_out"), F.count_if(~good).alias("rows_quarantined"),
        F.coalesce(F.sum(F.when(~good, n)), F.lit(0)).alias("raw_rows_quarantined"),
    )
    return facts.withColumn("rows_deduplicated", F.col("rows_in") - F.col("rows_out") - F.col("rows_quarantined"))
