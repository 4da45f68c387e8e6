"""The trip domain: schemas, names, and the ordered rules that tell valid rows from others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import any_of, column_or, month_of
from tidemark.functions.rules import Rule, RuleSet

_KINDS = {"int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(), "ntz": T.TimestampNTZType()}
#: The columns of a raw batch and their types, in order.
BRONZE_COLUMNS = [
    ("VendorID", "int"), ("tpep_pickup_datetime", "ntz"), ("tpep_dropoff_datetime", "ntz"), ("passenger_count", "long"),
    ("trip_distance", "double"), ("RatecodeID", "long"), ("store_and_fwd_flag", "string"), ("PULocationID", "int"),
    ("DOLocationID", "int"), ("payment_type", "long"), ("fare_amount", "double"), ("extra", "double"), ("mta_tax", "double"),
    ("tip_amount", "double"), ("tolls_amount", "double"), ("improvement_surcharge", "double"), ("total_amount", "double"),
    ("congestion_surcharge", "double"), ("Airport_fee", "double"), ("cbd_congestion_fee", "double"),
]
BRONZE_SCHEMA = T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in BRONZE_COLUMNS])
#: What a raw column is called once it is clean; raw columns without an entry end there.
CLEAN_NAMES = {
    "VendorID": "vendor_id", "tpep_pickup_datetime": "pickup_at", "tpep_dropoff_datetime": "dropoff_at", "passenger_count": "passenger_count",
    "trip_distance": "trip_distance_mi", "RatecodeID": "rate_code_id", "PULocationID": "pickup_location_id", "DOLocationID": "dropoff_location_id",
    "payment_type": "payment_type_id", "fare_amount": "fare_amount", "extra": "extra_amount", "mta_tax": "mta_tax_amount", "tip_amount": "tip_amount",
    "tolls_amount": "tolls_amount", "improvement_surcharge": "improvement_surcharge_amount", "total_amount": "total_amount",
    "congestion_surcharge": "congestion_surcharge_amount", "Airport_fee": "airport_fee_amount", "airport_fee": "airport_fee_amount",
    "cbd_congestion_fee": "cbd_congestion_fee_amount",
}
#: Columns that are not part of what a row says.
NOT_PAYLOAD = ["source_month", "source_snapshot_id", "pipeline_run_id", "batch_id"]
#: Columns that go along with a clean row, where it has them.
LINEAGE = [
    "_source_file", "_ingested_at", "_source_object_id", "_source_object_version", "source_month", "source_snapshot_id",
    "source_record_id", "trip_business_key", "pipeline_run_id", "batch_id",
]
BUSINESS_KEY = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"]
MONEY = [name for name in dict.fromkeys(CLEAN_NAMES.values()) if name.endswith("_amount")]
RAW_MONEY = [raw for raw, clean in CLEAN_NAMES.items() if clean.endswith("_amount")]
#: A decimal(10, 2) cannot hold this, rounded half up.
MONEY_LIMIT = 99_999_999.995
NEGOTIATED_RATE = 5
RESCUED = "_rescued_data"
REQUIRED = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", "trip_distance", "total_amount"]


def _number(df: DataFrame, name: str) -> Column:
    return column_or(df, name, F.lit(None)).cast("double")


def _not_finite(value: Column) -> Column:
    return F.isnan(value) | (F.abs(value) == F.lit(float("inf")))


def validity_rules(df: DataFrame) -> RuleSet:
    """The ten rules on a row by itself.  The first that holds gives the reason; null comparisons do not hold."""
    pickup, dropoff = (column_or(df, c, F.lit(None)).cast("timestamp_ntz") for c in REQUIRED[:2])
    fare, distance, total = (_number(df, c) for c in REQUIRED[2:])
    numbers = [c for c in ("trip_distance", *RAW_MONEY) if c in df.columns]
    amounts = [c for c in RAW_MONEY if c in df.columns]
    negotiated = F.coalesce(column_or(df, "RatecodeID", F.lit(None)).cast("double") == NEGOTIATED_RATE, F.lit(False))
    rules = [
        Rule("SCHEMA_RESCUED_DATA", column_or(df, RESCUED, F.lit(None)).isNotNull()),
        Rule("MISSING_REQUIRED_FIELD", any_of(column_or(df, c, F.lit(None)).isNull() for c in REQUIRED)),
        Rule("INVALID_NUMERIC_VALUE", any_of([*(_not_finite(_number(df, c)) for c in numbers), *(F.abs(_number(df, c)) >= MONEY_LIMIT for c in amounts)])),
        Rule("NEGATIVE_FARE", fare < 0),
        Rule("NONPOSITIVE_DURATION", F.unix_timestamp(dropoff) - F.unix_timestamp(pickup) <= 0),
    ]
    if "source_month" in df.columns:
        rules.append(Rule("OUTSIDE_SOURCE_MONTH", month_of(pickup) != F.col("source_month")))
    return RuleSet([
        *rules,
        Rule("NONPOSITIVE_TOTAL", total <= 0),
        Rule("NEGATIVE_DISTANCE", distance < 0),
        Rule("DISTANCE_FARE_MISMATCH", (distance == 0) & (fare > 0) & ~negotiated),
        Rule("ZERO_DISTANCE_ZERO_FARE", (distance == 0) & (fare == 0)),
    ])
