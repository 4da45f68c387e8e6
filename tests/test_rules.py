"""The ordered rules, identities and the way from a raw batch to clean rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import identity, trips
from tidemark.operators import reference, silver

DAY = dt.datetime(2024, 1, 15, 8, 0)
GOOD = {
    "VendorID": 1, "tpep_pickup_datetime": DAY, "tpep_dropoff_datetime": DAY + dt.timedelta(minutes=10), "passenger_count": 1, "trip_distance": 2.5,
    "RatecodeID": 1, "store_and_fwd_flag": None, "PULocationID": 4, "DOLocationID": 4, "payment_type": 1, "fare_amount": 12.0, "extra": 0.5, "mta_tax": 0.5,
    "tip_amount": 2.0, "tolls_amount": 0.0, "improvement_surcharge": 0.3, "total_amount": 15.3, "congestion_surcharge": 2.5, "Airport_fee": 0.0, "cbd_congestion_fee": 0.0,
}


def batch(spark, *changes, **columns):
    rows = [tuple((GOOD | change)[c] for c in trips.BRONZE_SCHEMA.names) for change in changes]
    return spark.createDataFrame(rows, trips.BRONZE_SCHEMA).withColumns(columns or {"_ingested_at": F.lit(DAY)})


@pytest.fixture(scope="module")
def lookups(spark):
    zones = spark.createDataFrame([(4, "M", "Z", False), (264, "U", "U", True)], "location_id int, borough string, zone string, is_sentinel boolean")
    return silver.trip_lookups(zones, reference.rate_codes(spark), reference.payment_types(spark))


CASES = [
    ({}, None), ({"fare_amount": None}, "MISSING_REQUIRED_FIELD"), ({"tpep_pickup_datetime": None}, "MISSING_REQUIRED_FIELD"), ({"tip_amount": math.nan}, "INVALID_NUMERIC_VALUE"),
    ({"total_amount": math.inf}, "INVALID_NUMERIC_VALUE"), ({"total_amount": 99_999_999.995}, "INVALID_NUMERIC_VALUE"), ({"trip_distance": 1e9}, None),
    ({"fare_amount": -5.0}, "NEGATIVE_FARE"), ({"tpep_dropoff_datetime": DAY}, "NONPOSITIVE_DURATION"), ({"total_amount": 0.0}, "NONPOSITIVE_TOTAL"),
    ({"trip_distance": -1.0}, "NEGATIVE_DISTANCE"), ({"trip_distance": 0.0}, "DISTANCE_FARE_MISMATCH"), ({"trip_distance": 0.0, "RatecodeID": 5}, None),
    ({"trip_distance": 0.0, "RatecodeID": None}, "DISTANCE_FARE_MISMATCH"), ({"trip_distance": 0.0, "fare_amount": 0.0}, "ZERO_DISTANCE_ZERO_FARE"),
    ({"fare_amount": -5.0, "tpep_dropoff_datetime": DAY}, "NEGATIVE_FARE"), ({"PULocationID": 99999}, "UNKNOWN_ZONE"), ({"DOLocationID": 264}, "SENTINEL_ZONE"),
    ({"RatecodeID": 99}, "UNKNOWN_RATE_CODE"), ({"RatecodeID": None}, "UNKNOWN_RATE_CODE"), ({"payment_type": 99}, "UNKNOWN_PAYMENT_TYPE"), ({"PULocationID": 264, "RatecodeID": 99}, "SENTINEL_ZONE"),
]


def test_reasons(spark, lookups):
    numbered = [change | {"VendorID": k} for k, (change, _) in enumerate(CASES)]
    found = {r["VendorID"]: r["reason_code"] for r in silver.classify(batch(spark, *numbered), lookups).select("VendorID", "reason_code").collect()}
    assert [found[k] for k in range(len(CASES))] == [reason for _, reason in CASES]


def test_rescued_and_other_months(spark, lookups):
    df = batch(spark, {}, _rescued_data=F.lit("{}"))
    assert silver.classify(df, lookups).first()["reason_code"] == "SCHEMA_RESCUED_DATA"
    df = batch(spark, {}, source_month=F.to_date(F.lit("2024-02-01")))
    assert silver.classify(df, lookups).first()["reason_code"] == "OUTSIDE_SOURCE_MONTH"


def test_identity_follows_the_payload(spark):
    two = identity.with_identities(batch(spark, {}, {"tip_amount": 3.0})).collect()
    again = identity.with_identities(batch(spark, {}, _ingested_at=F.lit(DAY), _source_file=F.lit("elsewhere"), source_month=F.lit("x"))).first()
    assert two[0]["trip_id"] == again["trip_id"] != two[1]["trip_id"]
    assert two[0]["trip_business_key"] == two[1]["trip_business_key"]
    assert "source_record_id" not in two[0].asDict()


def test_process(spark, lookups):
    valid, others = silver.process(batch(spark, {}, {}, {"fare_amount": -5.0}, {"fare_amount": -5.0}, {"tpep_pickup_datetime": dt.datetime(2024, 2, 1, 7), "tpep_dropoff_datetime": dt.datetime(2024, 2, 1, 8)}), lookups)
    assert valid.count() == 2 and others.count() == 1
    kinds = dict(valid.dtypes)
    assert kinds["fare_amount"] == "decimal(10,2)" and kinds["pickup_at"] == "timestamp_ntz" and "store_and_fwd_flag" not in kinds
    assert others.first()["reason_code"] == "NEGATIVE_FARE" and "fare_amount" in others.columns and "quarantined_at" in others.columns
    assert {str(r[0]) for r in silver.touched_months(valid).collect()} == {"2024-01-01", "2024-02-01"}


def test_metrics_are_conserved(spark, lookups):
    m = silver.metrics(silver.classify(batch(spark, {}, {}, {"fare_amount": -5.0}), lookups)).first().asDict()
    assert m == {"rows_in": 3, "rows_out": 1, "rows_quarantined": 1, "raw_rows_quarantined": 1, "rows_deduplicated": 1}


def test_newest_delivery_stays(spark, lookups):
    first, second = (batch(spark, {}, _ingested_at=F.lit(DAY + dt.timedelta(hours=h)), _source_file=F.lit(f)) for h, f in ((0, "old"), (1, "new")))
    valid, _ = silver.process(first.unionByName(second), lookups)
    assert [r["_source_file"] for r in valid.collect()] == ["new"]


def test_wall_clock_survives_session_zones(spark, lookups):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            moment = dt.datetime(2024, 3, 10, 2, 30)
            valid, _ = silver.process(batch(spark, {"tpep_pickup_datetime": moment, "tpep_dropoff_datetime": moment + dt.timedelta(minutes=5)}), lookups)
            assert valid.first()["pickup_at"] == moment
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_canonical_json():
    import decimal

    a = identity.canonical_json({"b": decimal.Decimal("1E+2"), "a": dt.date(2024, 1, 1)})
    assert a == '{"a":"2024-01-01","b":"100"}'
    assert identity.source_event_id("s", "1", {"x": 1, "y": 2}) == identity.source_event_id("s", "1", {"y": 2, "x": 1})
    with pytest.raises(ValueError):
        identity.object_key("a", "", "c", "d", "e")


def test_dimension_contract(spark):
    now = F.current_timestamp()
    good = reference.stamped(reference.rate_codes(spark))
    assert reference.validated(good, "rate_code_id", ["rate_code_name"]) is good
    for bad in (good.limit(0), good.unionByName(good), reference.stamped(reference.rate_codes(spark), reference.load_time(2000, 1, 1)), reference.stamped(reference.rate_codes(spark), now + F.expr("INTERVAL 2 DAYS")), reference.rate_codes(spark)):
        with pytest.raises(ValueError):
            reference.validated(bad, "rate_code_id")


def test_lookups_without_a_reason_column(spark, lookups):
    from tidemark.functions.rules import flag_unresolved

    assert flag_unresolved(batch(spark, {"RatecodeID": 99}), lookups).first()["reason_code"] == "UNKNOWN_RATE_CODE"
