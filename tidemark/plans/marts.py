"""Marts as declarations: a fact, its dimensions, keys and measures, and the writes of one month."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.tables import Table

#: A dimension of a star join: name of the frame, fact column, key column.
Dimension = tuple[str, str, str]


@dataclass(frozen=True)
class Mart:
    """keys, measures and shares: SQL expressions by output name; shares are computed from the measures."""

    name: str
    dimensions: Sequence[Dimension]
    keys: Mapping[str, str]
    measures: Mapping[str, str]
    shares: Mapping[str, str] = field(default_factory=dict)

    def build(self, fact: DataFrame, frames: Mapping[str, DataFrame]) -> DataFrame:
        """Star join, one aggregation, then the shares."""
        for name, column, key in self.dimensions:
            fact = fact.join(frames[name], F.col(column) == F.col(key))
        keyed = fact.select("*", *(F.expr(text).alias(f"__{name}") for name, text in self.keys.items()))
        grouped = keyed.groupBy(*(F.col(f"__{name}").alias(name) for name in self.keys)).agg(*(F.expr(text).alias(name) for name, text in self.measures.items()))
        return grouped.select("*", *(F.expr(text).alias(name) for name, text in self.shares.items()))


_PER_MILE = "CASE WHEN NOT is_flat_fare AND trip_distance_mi > 0 THEN CAST(fare_amount AS DOUBLE) / trip_distance_mi END"
_TIP = "CASE WHEN tip_is_recorded THEN CAST(tip_amount AS DOUBLE) / nullif(CAST(fare_amount AS DOUBLE), 0D) END"
REVENUE = Mart(
    "revenue_by_zone_hour", [("zones", "pickup_location_id", "location_id")],
    {"pickup_date": "to_date(pickup_at)", "pickup_hour": "hour(pickup_at)", "pickup_location_id": "pickup_location_id", "pickup_borough": "borough", "pickup_zone": "zone"},
    {
        "trip_count": "count(*)", "total_revenue": "CAST(sum(CAST(total_amount AS DECIMAL(10,2))) AS DECIMAL(12,2))",
        "avg_fare_amount": "CAST(avg(CAST(fare_amount AS DECIMAL(10,2))) AS DECIMAL(10,2))", "avg_trip_distance_mi": "avg(trip_distance_mi)",
    },
)
INTEGRITY = Mart(
    "fare_integrity_daily", [("rate_codes", "rate_code_id", "__rate_code_id")], {"pickup_date": "to_date(pickup_at)", "is_flat_fare": "is_flat_fare"},
    {"trip_count": "count(*)", "avg_fare_per_mile": f"avg({_PER_MILE})", "fare_per_mile_p95": f"percentile_approx({_PER_MILE}, 0.95)"},
)
PAYMENT = Mart(
    "payment_mix_monthly", [("payment_types", "payment_type_id", "__payment_type_id")], {"payment_type_name": "payment_type_name"},
    {"trip_count": "count(*)", "avg_tip_pct": f"avg({_TIP})"}, {"pct_of_month_trips": "trip_count / sum(trip_count) OVER ()"},
)
MARTS = [REVENUE, INTEGRITY, PAYMENT]


def build_month(silver: DataFrame, month: str, zones: DataFrame, rate_codes: DataFrame, payment_types: DataFrame) -> dict[str, DataFrame]:
    """Each mart of one month of clean trips."""
    fact = silver.filter(F.col("pickup_month") == F.to_date(F.lit(month)))
    frames = {
        "zones": zones.select("location_id", "borough", "zone"), "rate_codes": rate_codes.select(F.col("rate_code_id").alias("__rate_code_id"), "is_flat_fare"),
        "payment_types": payment_types.select(F.col("payment_type_id").alias("__payment_type_id"), "payment_type_name", "tip_is_recorded"),
    }
    return {mart.name: mart.build(fact, frames).withColumn("pickup_month", F.to_date(F.lit(month))) for mart in MARTS}


def write_month(marts: Mapping[str, DataFrame], folder: str, month: str) -> None:
    """Overwrites the month in each mart's table, also by nothing."""
    for name, frame in marts.items():
        Table(frame.sparkSession, f"{folder}/{name}", "pickup_month").replace_partition(frame, month)


def reconciled(silver: DataFrame, marts: Mapping[str, DataFrame], month: str) -> None:
    """Raises unless every mart has all trips of the month, and revenue is the same to the cent."""
    fact = silver.filter(F.col("pickup_month") == F.to_date(F.lit(month))).agg(F.count("*").alias("n"), F.sum("total_amount").alias("revenue")).first()
    for name, frame in marts.items():
        revenue = F.sum("total_revenue") if "total_revenue" in frame.columns else F.lit(None)
        got = frame.agg(F.coalesce(F.sum("trip_count"), F.lit(0)).alias("n"), revenue.alias("revenue")).first()
        if got["n"] != fact["n"] or ("total_revenue" in frame.columns and got["revenue"] != fact["revenue"]):
            raise ValueError(f"{name} of {month}: {got['n']} trips, {got['revenue']}; silver has {fact['n']}, {fact['revenue']}")
