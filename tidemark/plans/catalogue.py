"""Named queries over the driver's tables, each with the SQL that says the same to DuckDB.

The trip domain stands on the tables like this: events are trips by the hour, customer and nation their zones; lineitem is a
batch of trips with prices, quantities and dates, orders its payment types, part its flat fares, supplier and nation its
places.  Every query is deterministic and uses whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import any_of, between_dates, column_or, month_of, share
from tidemark.functions.rules import Lookup, Rule, RuleSet, flag_unresolved
from tidemark.functions.salting import salted_count
from tidemark.operators import reference, silver
from tidemark.operators.dedup import duplicate_keys, first_by
from tidemark.operators.quantiles import exact_quantile
from tidemark.operators.tables import Table, difference, same_rows, upserted, without, work_folder
from tidemark.plans import config, monitor, publish, quality, state
from tidemark.sources.pages import first_seen
from tidemark.streaming import bronze

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None):
    """Registers a query under its name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# -- marts ------------------------------------------------------------------------------------------------------------

_MONEY = "decimal(10,2)"


def _zoned_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the nation and region of their customer; the two small dimensions are joined first."""
    nations = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    zones = _read(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_nationkey", "n_name", "r_name")
    return _read(spark, sf_dir, "events").join(zones, F.col("user_id") == F.col("c_custkey"))


@query("""
SELECT CAST(ts AS DATE) AS pickup_date, CAST(hour(ts) AS INTEGER) AS pickup_hour, n_nationkey AS zone_id, r_name AS borough, n_name AS zone,
       count(*) AS trip_count, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(12,2)) AS total_revenue,
       CAST(sum(CAST(value AS DECIMAL(10,2))) AS DOUBLE) / count(*) AS avg_amount
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY 1, 2, 3, 4, 5
""")
def revenue_by_zone_hour(spark, sf_dir):
    trips = _zoned_events(spark, sf_dir).filter(between_dates(F.col("ts"), "2024-01-01", "2024-02-01"))
    amount = F.sum(F.col("value").cast(_MONEY))
    keys = [F.col("ts").cast("date").alias("pickup_date"), F.hour("ts").cast("int").alias("pickup_hour"), F.col("n_nationkey").alias("zone_id"), F.col("r_name").alias("borough"), F.col("n_name").alias("zone")]
    return trips.groupBy(*keys).agg(F.count("*").alias("trip_count"), amount.cast("decimal(12,2)").alias("total_revenue"), (amount.cast("double") / F.count("*")).alias("avg_amount"))


@query("""
SELECT CAST(l_shipdate AS DATE) AS pickup_date, p_size >= 40 AS is_flat_fare, count(*) AS trip_count, round(avg(x), 6) AS avg_fare_per_mile, quantile_disc(x, 0.95) AS fare_per_mile_p95
FROM (SELECT *, CASE WHEN p_size < 40 AND l_quantity > 0 THEN l_extendedprice / l_quantity END AS x FROM lineitem JOIN part ON l_partkey = p_partkey)
WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-02-01' GROUP BY 1, 2
""")
def fare_integrity(spark, sf_dir):
    month = _read(spark, sf_dir, "lineitem").filter(between_dates(F.col("l_shipdate"), "1996-01-01", "1996-02-01"))
    trips = month.join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    per_mile = F.when((F.col("p_size") < 40) & (F.col("l_quantity") > 0), F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0)))
    keys = ["pickup_date", "is_flat_fare"]
    fares = trips.select(F.col("l_shipdate").cast("date").alias("pickup_date"), (F.col("p_size") >= 40).alias("is_flat_fare"), per_mile.alias("per_mile"))
    counted = fares.groupBy(*keys).agg(F.count("*").alias("trip_count"), F.round(F.avg("per_mile"), 6).alias("avg_fare_per_mile"))
    p95 = exact_quantile(fares, keys, F.col("per_mile"), 0.95, "fare_per_mile_p95").withColumnsRenamed({k: f"own_{k}" for k in keys})
    same = F.col("pickup_date").eqNullSafe(F.col("own_pickup_date")) & F.col("is_flat_fare").eqNullSafe(F.col("own_is_flat_fare"))
    return counted.join(p95, same, "left").drop("own_pickup_date", "own_is_flat_fare")


@query("""
SELECT o_orderpriority AS payment_type_name, count(*) AS trip_count, count(*) / sum(count(*)) OVER () AS pct_of_month_trips,
       round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN l_discount / nullif(l_tax, 0) END), 6) AS avg_tip_pct
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate >= TIMESTAMP '1996-01-01' AND l_shipdate < TIMESTAMP '1996-02-01' GROUP BY 1
""")
def payment_mix(spark, sf_dir):
    from pyspark.sql import Window

    month = _read(spark, sf_dir, "lineitem").filter(between_dates(F.col("l_shipdate"), "1996-01-01", "1996-02-01"))
    trips = month.join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    tip = F.when(F.col("o_orderpriority") == "1-URGENT", share(F.col("l_discount"), F.col("l_tax")))
    counted = trips.groupBy(F.col("o_orderpriority").alias("payment_type_name")).agg(F.count("*").alias("trip_count"), F.round(F.avg(tip), 6).alias("avg_tip_pct"))
    return counted.withColumn("pct_of_month_trips", F.col("trip_count") / F.sum("trip_count").over(Window.partitionBy()))


# -- rules and look-ups -----------------------------------------------------------------------------------------------

_RATES_SQL = "(VALUES (1), (2), (3), (4), (5), (6)) AS rates(rate)"


@query(f"""
SELECT coalesce(CASE WHEN l_discount >= 0.10 THEN 'HIGH_DISCOUNT' WHEN l_quantity < 2 THEN 'SMALL_QUANTITY' END,
                CASE WHEN n_nationkey IS NULL THEN 'UNKNOWN_ZONE' WHEN n_nationkey = 24 THEN 'SENTINEL_ZONE' WHEN rate IS NULL THEN 'UNKNOWN_RATE_CODE' END) AS reason_code,
       count(*) AS n
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 23) ON s_nationkey = n_nationkey
LEFT JOIN {_RATES_SQL} ON l_linenumber = rate GROUP BY 1
""")
def fk_classify(spark, sf_dir):
    rates = reference.rate_codes(spark).select(F.col("rate_code_id").alias("rate"))
    zones = _read(spark, sf_dir, "nation").filter("n_nationkey <> 23").withColumn("is_sentinel", F.col("n_nationkey") == 24)
    facts = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    rules = RuleSet([Rule("HIGH_DISCOUNT", F.col("l_discount") >= 0.10), Rule("SMALL_QUANTITY", F.col("l_quantity") < 2)])
    lookups = [Lookup(zones, "n_nationkey", ["s_nationkey"], "UNKNOWN_ZONE", "is_sentinel", "SENTINEL_ZONE"), Lookup(rates, "rate", ["l_linenumber"], "UNKNOWN_RATE_CODE")]
    return flag_unresolved(facts.withColumn("reason_code", rules.reason()), lookups).groupBy("reason_code").agg(F.count("*").alias("n"))


#: The batch of raw trips that lineitem stands for, as SQL of both engines.
_TRIPS_SQL = """
SELECT CAST(l_suppkey % 3 AS INTEGER) AS VendorID, l_shipdate AS tpep_pickup_datetime,
       CASE WHEN l_partkey % 41 = 0 THEN NULL WHEN l_partkey % 37 = 0 THEN l_shipdate ELSE l_shipdate + INTERVAL '10' MINUTE END AS tpep_dropoff_datetime,
       CAST(l_suppkey % 27 AS INTEGER) AS PULocationID, CAST(l_partkey % 25 AS INTEGER) AS DOLocationID,
       CAST(l_linenumber AS BIGINT) AS RatecodeID, CAST(l_orderkey % 7 AS BIGINT) AS payment_type,
       CASE WHEN l_partkey % 29 = 0 THEN 0.0 WHEN l_partkey % 53 = 0 THEN -1.0 ELSE l_quantity END AS trip_distance,
       CASE WHEN l_orderkey % 31 = 0 THEN -l_extendedprice WHEN l_orderkey % 43 = 0 THEN 0.0 ELSE l_extendedprice END AS fare_amount,
       l_discount AS tip_amount, CASE WHEN l_orderkey % 47 = 0 THEN 0.0 ELSE l_extendedprice END AS total_amount,
       CASE WHEN l_suppkey % 19 = 0 THEN '{"extra": 1}' END AS _rescued_data, CAST(date_trunc('month', l_shipdate) AS DATE) AS source_month
FROM lineitem
""".replace("0.0", "CAST(0 AS DOUBLE)").replace("-1.0", "CAST(-1 AS DOUBLE)")
_REASON_SQL = """
CASE WHEN _rescued_data IS NOT NULL THEN 'SCHEMA_RESCUED_DATA' WHEN tpep_dropoff_datetime IS NULL THEN 'MISSING_REQUIRED_FIELD'
     WHEN fare_amount < 0 THEN 'NEGATIVE_FARE' WHEN tpep_dropoff_datetime <= tpep_pickup_datetime THEN 'NONPOSITIVE_DURATION'
     WHEN total_amount <= 0 THEN 'NONPOSITIVE_TOTAL' WHEN trip_distance < 0 THEN 'NEGATIVE_DISTANCE'
     WHEN trip_distance = 0 AND fare_amount > 0 AND RatecodeID <> 5 THEN 'DISTANCE_FARE_MISMATCH'
     WHEN trip_distance = 0 AND fare_amount = 0 THEN 'ZERO_DISTANCE_ZERO_FARE'
     WHEN PULocationID >= 25 THEN 'UNKNOWN_ZONE' WHEN PULocationID = 24 OR DOLocationID = 24 THEN 'SENTINEL_ZONE'
     WHEN RatecodeID = 7 THEN 'UNKNOWN_RATE_CODE' WHEN payment_type = 0 THEN 'UNKNOWN_PAYMENT_TYPE' END
"""
_CHECKED_SQL = f"WITH trips AS ({_TRIPS_SQL}), checked AS (SELECT *, {_REASON_SQL} AS reason_code FROM trips)"
_PAYLOAD = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, PULocationID, DOLocationID, RatecodeID, payment_type, trip_distance, fare_amount, tip_amount, total_amount"


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_TRIPS_SQL.replace("FROM lineitem", "FROM {lineitem}").replace('\'{"extra": 1}\'', "'{{\"extra\": 1}}'"), lineitem=_read(spark, sf_dir, "lineitem"))


def _trip_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones; the last one stands for no place."""
    return _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("location_id"), F.lit("all").alias("borough"), F.col("n_name").alias("zone"), (F.col("n_nationkey") == 24).alias("is_sentinel"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.classify(_trips(spark, sf_dir), silver.trip_lookups(_trip_zones(spark, sf_dir), reference.rate_codes(spark), reference.payment_types(spark)))


@query(f"{_CHECKED_SQL} SELECT reason_code, count(*) AS n FROM checked GROUP BY 1")
def classify_reasons(spark, sf_dir):
    return _checked(spark, sf_dir).groupBy("reason_code").agg(F.count("*").alias("n"))


@query(f"""
SELECT *, rows_in - rows_out - rows_quarantined AS rows_deduplicated FROM ({_CHECKED_SQL}
SELECT count(*) AS rows_in, (SELECT count(*) FROM (SELECT DISTINCT {_PAYLOAD} FROM checked WHERE reason_code IS NULL)) AS rows_out,
       (SELECT count(*) FROM (SELECT DISTINCT {_PAYLOAD}, reason_code FROM checked WHERE reason_code IS NOT NULL)) AS rows_quarantined,
       count(reason_code) AS raw_rows_quarantined FROM checked)
""")
def silver_metrics(spark, sf_dir):
    return silver.metrics(_checked(spark, sf_dir))


@query(f"""
{_CHECKED_SQL}, valid AS (SELECT DISTINCT {_PAYLOAD}, source_month FROM checked WHERE reason_code IS NULL),
others AS (SELECT DISTINCT {_PAYLOAD}, reason_code FROM checked WHERE reason_code IS NOT NULL)
SELECT source_month AS pickup_month, 'valid' AS kind, count(*) AS n, sum(CAST(fare_amount AS DECIMAL(10,2)))::DECIMAL(20,2) AS fares FROM valid GROUP BY 1
UNION ALL SELECT NULL, reason_code, count(*), NULL FROM others GROUP BY 2
""")
def silver_pipeline(spark, sf_dir):
    lookups = silver.trip_lookups(_trip_zones(spark, sf_dir), reference.rate_codes(spark), reference.payment_types(spark))
    valid, others = silver.process(_trips(spark, sf_dir), lookups)
    a = valid.groupBy("pickup_month").agg(F.lit("valid").alias("kind"), F.count("*").alias("n"), F.sum("fare_amount").cast("decimal(20,2)").alias("fares"))
    b = others.groupBy(F.col("reason_code").alias("kind")).agg(F.count("*").alias("n"))
    return a.unionByName(b.select(F.lit(None).cast("date").alias("pickup_month"), "kind", "n", F.lit(None).cast("decimal(20,2)").alias("fares")))


@query("""
SELECT isnan(x) AS nan, isinf(x) AS infinite, abs(x) >= 99999999.995 AS too_large, count(*) AS n FROM (
    SELECT CASE WHEN event_id % 11 = 0 THEN 'nan'::DOUBLE WHEN event_id % 13 = 0 THEN 'inf'::DOUBLE WHEN event_id % 17 = 0 THEN '-inf'::DOUBLE ELSE value * 1000000 END AS x FROM events)
GROUP BY 1, 2, 3
""")
def numeric_guards(spark, sf_dir):
    e = F.col("event_id")
    x = F.when(e % 11 == 0, F.lit(float("nan"))).when(e % 13 == 0, F.lit(float("inf"))).when(e % 17 == 0, F.lit(float("-inf"))).otherwise(F.col("value") * 1000000)
    flags = [F.isnan("x").alias("nan"), (F.abs("x") == F.lit(float("inf"))).alias("infinite"), (F.abs("x") >= 99999999.995).alias("too_large")]
    return _read(spark, sf_dir, "events").select(x.alias("x")).groupBy(*flags).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(*) FILTER (l_tax = 0 OR l_discount = 0 OR l_quantity >= 50) AS any_holds FROM lineitem")
def any_condition(spark, sf_dir):
    holds = any_of([F.col("l_tax") == 0, F.col("l_discount") == 0, F.col("l_quantity") >= 50])
    return _read(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"), F.count_if(holds).alias("any_holds"))


@query("SELECT l_returnflag, CAST(NULL AS VARCHAR) AS rescued, count(*) AS n FROM lineitem GROUP BY 1")
def missing_column(spark, sf_dir):
    items = _read(spark, sf_dir, "lineitem")
    return items.groupBy("l_returnflag", column_or(items, "_rescued_data", F.lit(None).cast("string")).alias("rescued")).agg(F.count("*").alias("n"))


# -- dedup ------------------------------------------------------------------------------------------------------------

@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1
""")
def dedup_latest(spark, sf_dir):
    order = [F.col("l_shipdate").desc_nulls_last(), *map(F.col, ("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"))]
    return first_by(_read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order).select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("""
SELECT user_id, event_type, event_id, event_id // 100 AS page FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id // 100, event_id % 100) = 1
""")
def first_seen_dedup(spark, sf_dir):
    paged = _read(spark, sf_dir, "events").withColumns({"page": F.floor(F.col("event_id") / 100).cast("long"), "position": F.col("event_id") % 100})
    return first_seen(paged, ["user_id", "event_type"], "page", "position").select("user_id", "event_type", "event_id", "page")


@query("""
SELECT count(*) AS different FROM (
    (SELECT event_id, value FROM events WHERE event_id % 10 < 8 EXCEPT ALL SELECT event_id, value FROM events WHERE event_id % 10 >= 2) UNION ALL
    (SELECT event_id, value FROM events WHERE event_id % 10 >= 2 EXCEPT ALL SELECT event_id, value FROM events WHERE event_id % 10 < 8))
""")
def replay_invariant(spark, sf_dir):
    events = _read(spark, sf_dir, "events").select("event_id", "value")
    return same_rows(events.filter("event_id % 10 < 8"), events.filter("event_id % 10 >= 2"))


# -- projections ------------------------------------------------------------------------------------------------------

@query("""
SELECT l_orderkey AS order_id, l_linenumber AS line_id, CAST(l_extendedprice AS DECIMAL(10,2)) AS fare_amount, CAST(l_tax AS DECIMAL(10,2)) AS tax_amount,
       l_shipdate AS pickup_at, CAST(date_trunc('month', l_shipdate) AS DATE) AS pickup_month FROM lineitem
""")
def silver_rename_cast(spark, sf_dir):
    names = {"l_orderkey": "order_id", "l_linenumber": "line_id", "l_extendedprice": "fare_amount", "l_tax": "tax_amount", "l_shipdate": "pickup_at", "absent": "absent"}
    items = _read(spark, sf_dir, "lineitem")
    renamed = items.select(*(F.col(raw).alias(name) for raw, name in names.items() if raw in items.columns))
    money = {c: F.col(c).cast(_MONEY) for c in ("fare_amount", "tax_amount")}
    return renamed.withColumns(money | {"pickup_at": F.col("pickup_at").cast("timestamp_ntz")}).withColumn("pickup_month", month_of(F.col("pickup_at")))


@query("SELECT 'run-1' AS pipeline_run_id, 'b1' AS batch_id, DATE '2024-01-01' AS source_month, event_type, count(*) AS n FROM events GROUP BY ALL")
def batch_tags(spark, sf_dir):
    tagged = _read(spark, sf_dir, "events").withColumns({"pipeline_run_id": F.lit("run-1"), "batch_id": F.lit("b1"), "source_month": F.to_date(F.lit("2024-01-01"))})
    return tagged.groupBy("pipeline_run_id", "batch_id", "source_month", "event_type").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-04-01' AND l_quantity > 25 AND NOT l_returnflag = 'R'")
def scan_filter(spark, sf_dir):
    march = between_dates(F.col("l_shipdate"), "1997-03-01", "1997-04-01")
    return _read(spark, sf_dir, "lineitem").filter(march & (F.col("l_quantity") > 25) & ~(F.col("l_returnflag") == "R")).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey IN (1, 3)")
def in_list(spark, sf_dir):
    return _read(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(1, 3)).select("n_nationkey", "n_name")


@query("SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS pickup_month FROM lineitem")
def touched_months(spark, sf_dir):
    return silver.touched_months(_read(spark, sf_dir, "lineitem").select(month_of(F.col("l_shipdate")).alias("pickup_month")))


@query("SELECT event_id, CAST(ts AS DATE) AS day, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, CAST(date_trunc('month', ts) AS DATE) AS month_start, CAST(hour(ts) AS INTEGER) AS hour_of_day FROM events")
def time_buckets(spark, sf_dir):
    ts = F.col("ts")
    return _read(spark, sf_dir, "events").select("event_id", ts.cast("date").alias("day"), F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour_start"), month_of(ts).alias("month_start"), F.hour(ts).cast("int").alias("hour_of_day"))


@query("SELECT event_id, sha256(concat_ws('|', CAST(event_id AS VARCHAR), event_type)) AS record_id FROM events")
def hash_identity(spark, sf_dir):
    from tidemark.functions.identity import digest

    return _read(spark, sf_dir, "events").select("event_id", digest(F.col("event_id").cast("string"), F.col("event_type")).alias("record_id"))


@query("SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, count(*) AS n FROM events GROUP BY 1")
def json_extract(spark, sf_dir):
    return _read(spark, sf_dir, "events").groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))


_PATH_SQL = "'gs://raw/source_month=2024-0' || CAST(1 + event_id % 9 AS VARCHAR) || '/snapshot=' || sha256(CAST(event_id % 9 AS VARCHAR)) || '/data.parquet'"


@query(f"""
SELECT event_id, regexp_extract(path, 'snapshot=([0-9a-f]{{64}})', 1) AS snapshot_id, CAST(regexp_extract(path, 'source_month=(\\d{{4}}-\\d{{2}})', 1) || '-01' AS DATE) AS source_month
FROM (SELECT event_id, {_PATH_SQL} AS path FROM events)
""")
def path_extract(spark, sf_dir):
    part = (F.col("event_id") % 9).cast("string")
    path = F.concat(F.lit("gs://raw/source_month=2024-0"), (F.col("event_id") % 9 + 1).cast("string"), F.lit("/snapshot="), F.sha2(part, 256), F.lit("/data.parquet"))
    return _read(spark, sf_dir, "events").select("event_id", bronze.snapshot_in(path).alias("snapshot_id"), bronze.month_in(path).alias("source_month"))


# -- joins and aggregates ---------------------------------------------------------------------------------------------

_STAR_SQL = """
SELECT n_name, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total
FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01' GROUP BY 1, 2
"""


def _star(spark: SparkSession, sf_dir: str, hint: str) -> DataFrame:
    nations = _read(spark, sf_dir, "nation").hint(hint)
    trips = _read(spark, sf_dir, "events").filter(between_dates(F.col("ts"), "2024-01-01", "2024-02-01")).join(_read(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
    joined = trips.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    hours = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start")
    return joined.groupBy("n_name", hours).agg(F.count("*").alias("n"), F.sum(F.col("value").cast(_MONEY)).cast("decimal(20,2)").alias("total"))


@query(_STAR_SQL)
def join_broadcast(spark, sf_dir):
    """The nations, of which there are 25, are sent to every task."""
    return _star(spark, sf_dir, "broadcast")


@query(_STAR_SQL)
def join_sort_merge(spark, sf_dir):
    return _star(spark, sf_dir, "merge")


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def salted_agg(spark, sf_dir):
    return salted_count(_read(spark, sf_dir, "events"), ["user_id"], F.col("event_id")).select("user_id", F.col("n").cast("bigint").alias("n"))


_ZONE_HOUR_SQL = """
SELECT c_nationkey AS zone_id, CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS n FROM events JOIN customer ON user_id = c_custkey GROUP BY 1, 2
"""


def _zone_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _read(spark, sf_dir, "events").join(_read(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
    return trips.select(F.col("c_nationkey").alias("zone_id"), F.hour("ts").cast("int").alias("hour_of_day"), "event_id")


@query(_ZONE_HOUR_SQL)
def zone_hour(spark, sf_dir):
    return _zone_hours(spark, sf_dir).groupBy("zone_id", "hour_of_day").agg(F.count("*").alias("n"))


@query(_ZONE_HOUR_SQL)
def zone_hour_salted(spark, sf_dir):
    """The same with eight salts; partial aggregation before the shuffle makes it rarely worth it."""
    return salted_count(_zone_hours(spark, sf_dir), ["zone_id", "hour_of_day"], F.col("event_id"))


def _hourly(events: DataFrame) -> DataFrame:
    hours = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour_start")
    return events.groupBy(hours).agg(F.count("*").alias("n"), F.sum(F.col("value").cast(_MONEY)).cast("decimal(20,2)").alias("total"))


_HOURLY_SQL = "SELECT CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total FROM events {} GROUP BY 1"


@query(_HOURLY_SQL.format("WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-02-01'"))
def hourly_month(spark, sf_dir):
    return _hourly(_read(spark, sf_dir, "events").filter(between_dates(F.col("ts"), "2024-01-01", "2024-02-01")))


@query(_HOURLY_SQL.format(""))
def hourly_full(spark, sf_dir):
    return _hourly(_read(spark, sf_dir, "events"))


@query("SELECT l_returnflag, quantile_disc(l_extendedprice / l_quantity, 0.95) AS p95 FROM lineitem GROUP BY 1")
def p95_exact(spark, sf_dir):
    return exact_quantile(_read(spark, sf_dir, "lineitem"), ["l_returnflag"], share(F.col("l_extendedprice"), F.col("l_quantity")), 0.95, "p95")


@query("SELECT count(*) AS n, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total, max(ts) AS newest FROM events")
def global_agg(spark, sf_dir):
    return _read(spark, sf_dir, "events").agg(F.count("*").alias("n"), F.sum(F.col("value").cast(_MONEY)).cast("decimal(20,2)").alias("total"), F.max("ts").alias("newest"))


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dup_keys(spark, sf_dir):
    return duplicate_keys(_read(spark, sf_dir, "lineitem"), "l_orderkey")


# -- reference data ---------------------------------------------------------------------------------------------------

@query("SELECT n_nationkey AS location_id, r_name AS borough, n_name AS zone, n_nationkey IN (23, 24) AS is_sentinel FROM nation JOIN region ON n_regionkey = r_regionkey")
def dim_zone_sentinel(spark, sf_dir):
    """Zones by way of a CSV file, as they are delivered."""
    folder = work_folder(spark)
    nations = _read(spark, sf_dir, "nation").join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    coded = F.when(F.col("n_nationkey").isin(23, 24), F.col("n_nationkey") + 241).otherwise(F.col("n_nationkey"))
    nations.select(coded.alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"), F.lit("all").alias("service_zone")).write.option("header", True).csv(f"{folder}/zones")
    found = reference.zones(spark, f"{folder}/zones")
    return found.select(F.when(F.col("is_sentinel"), F.col("location_id") - 241).otherwise(F.col("location_id")).alias("location_id"), "borough", "zone", "is_sentinel")


@query("""
SELECT v.*, count(l_linenumber) AS n_trips, true AS stamped
FROM (VALUES (1, 'Standard', false), (2, 'JFK', true), (3, 'Newark', true), (4, 'Nassau or Westchester', false), (5, 'Negotiated fare', false), (6, 'Group ride', false)) AS v(rate_code_id, rate_code_name, is_flat_fare)
LEFT JOIN lineitem ON l_linenumber = rate_code_id GROUP BY ALL
""")
def rate_code_seed(spark, sf_dir):
    """The seed, loaded twice, with the trips that have each code."""
    table = Table(spark, f"{work_folder(spark)}/rate_code")
    table.overwrite(reference.rate_codes(spark))
    table.overwrite(reference.stamped(table.read(), reference.load_time(2024, 1, 1)))
    trips = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_linenumber").alias("rate_code_id")).agg(F.count("*").alias("n_trips"))
    found = table.read().withColumn("stamped", F.col("_loaded_at") == reference.load_time(2024, 1, 1)).drop("_loaded_at").join(trips, "rate_code_id", "left")
    return found.withColumn("n_trips", F.coalesce("n_trips", F.lit(0).cast("long")))


@query("""
SELECT count(*) AS rows, count(*) FILTER (k IS NULL OR c_name IS NULL) AS missing, count(*) FILTER (loaded < TIMESTAMP '2024-02-01' - INTERVAL 90 DAY) AS stale,
       count(*) FILTER (loaded > TIMESTAMP '2024-02-01') AS from_the_future, (SELECT count(*) FROM (SELECT c_custkey % 1000 FROM customer GROUP BY 1 HAVING count(*) > 1)) AS duplicate_keys
FROM (SELECT c_custkey % 1000 AS k, c_name, TIMESTAMP '2024-03-01' - to_days(CAST(c_custkey % 200 AS INTEGER)) AS loaded FROM customer)
""")
def dim_contract(spark, sf_dir):
    aged = F.expr("CAST(TIMESTAMP '2024-03-01' - make_dt_interval(CAST(c_custkey % 200 AS INT)) AS TIMESTAMP)")
    dim = _read(spark, sf_dir, "customer").select((F.col("c_custkey") % 1000).alias("k"), "c_name", aged.alias("_loaded_at"))
    return reference.contract(dim, "k", ["c_name"], reference.load_time(2024, 2, 1))


# -- gate -------------------------------------------------------------------------------------------------------------

_SNAPSHOT_METRICS_SQL = """
SELECT event_type AS source_snapshot_id, count(*) AS rows_in, count(*) FILTER (value >= 10) AS rows_out, count(*) FILTER (value < 10 AND user_id % 5 > 0) AS rows_quarantined,
       count(*) FILTER (value < 10) AS raw_rows_quarantined, count(*) FILTER (value < 10 AND user_id % 5 = 0) AS rows_deduplicated FROM events GROUP BY 1
"""


def _snapshot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, again = F.col("value") < 10, F.col("user_id") % 5 == 0
    return _read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source_snapshot_id")).agg(
        F.count("*").alias("rows_in"), F.count_if(~low).alias("rows_out"), F.count_if(low & ~again).alias("rows_quarantined"), F.count_if(low).alias("raw_rows_quarantined"), F.count_if(low & again).alias("rows_deduplicated")
    )


@query(f"""
WITH m AS ({_SNAPSHOT_METRICS_SQL}), s AS (SELECT event_type AS snapshot_id, count(*) + CAST(event_type = 'click' AS INTEGER) AS rows_received FROM events GROUP BY event_type UNION ALL SELECT 'late', 5)
SELECT coalesce(snapshot_id, source_snapshot_id) AS snapshot_id, rows_in, raw_rows_quarantined / rows_in AS quarantine_rate,
       CASE WHEN source_snapshot_id IS NULL THEN 'NO_METRICS' WHEN rows_received <> rows_in THEN 'ROWS_LOST' WHEN rows_in <> rows_out + rows_quarantined + rows_deduplicated THEN 'NOT_CONSERVED'
            WHEN raw_rows_quarantined / rows_in > 0.1 THEN 'QUARANTINE_RATE' ELSE 'PASS' END AS verdict
FROM s FULL JOIN m ON snapshot_id = source_snapshot_id
""")
def dq_gate(spark, sf_dir):
    received = _read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("snapshot_id")).agg(F.count("*").alias("n"))
    received = received.select("snapshot_id", (F.col("n") + (F.col("snapshot_id") == "click").cast("int")).alias("rows_received"))
    late = spark.createDataFrame([("late", 5)], "snapshot_id string, rows_received long")
    return quality.verdicts(_snapshot_metrics(spark, sf_dir), received.unionByName(late), 0.1)


@query("SELECT (SELECT count(*) FROM events WHERE value < 10) / nullif((SELECT count(*) FROM events), 0) AS rate, (SELECT count(*) FROM events WHERE value < 10) / (SELECT count(*) FROM events) <= 0.9 AS passes")
def dq_rate(spark, sf_dir):
    """Two scalar subqueries and an assertion, which stops the query where it does not hold."""
    sql = "SELECT (SELECT count(*) FROM {e} WHERE value < 10) / nullif((SELECT count(*) FROM {e}), 0) AS rate"
    rate = spark.sql(sql, e=_read(spark, sf_dir, "events"))
    message = F.concat(F.lit("quarantine rate "), F.round(F.col("rate") * 100, 2).cast("string"), F.lit(" %"))
    return rate.withColumn("passes", F.coalesce(F.assert_true(F.col("rate") <= 0.9, message).cast("boolean"), F.lit(True)))


@query(f"SELECT source_snapshot_id, raw_rows_quarantined / rows_in AS quarantine_rate, CASE WHEN raw_rows_quarantined / rows_in > 0.1 THEN 'BLOCKED_BY_DQ' ELSE 'PASS' END AS status FROM ({_SNAPSHOT_METRICS_SQL})")
def dq_report(spark, sf_dir):
    rates = _snapshot_metrics(spark, sf_dir).select("source_snapshot_id", share(F.col("raw_rows_quarantined"), F.col("rows_in")).alias("quarantine_rate"))
    return quality.report(rates, 0.1)


# -- table writes -----------------------------------------------------------------------------------------------------

@query("SELECT o_orderkey, o_totalprice FROM orders")
def merge_insert_only(spark, sf_dir):
    """Two overlapping deliveries; the second adds what the first does not have, and adding it again adds nothing."""
    orders = _read(spark, sf_dir, "orders")
    table = Table(spark, f"{work_folder(spark)}/orders")
    table.insert_new(orders.filter("o_orderdate < TIMESTAMP_NTZ '1996-01-01' OR o_orderdate IS NULL").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    for _ in range(2):
        table.insert_new(orders.filter("o_orderdate >= TIMESTAMP_NTZ '1994-01-01'").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    return table.read()


_MONTHLY_SQL = "SELECT o_orderkey, o_totalprice, CAST(date_trunc('month', o_orderdate) AS DATE) AS source_month FROM orders"
_CORRECTION_SQL = f"SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, source_month FROM ({_MONTHLY_SQL}) WHERE source_month = DATE '1995-03-01' AND o_totalprice < 200000"


def _monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", month_of(F.col("o_orderdate")).alias("source_month"))


def _correction(months: DataFrame) -> DataFrame:
    """A month as a source may deliver it again: dear orders are gone, the others cost one more."""
    return months.filter((F.col("source_month") == F.to_date(F.lit("1995-03-01"))) & (F.col("o_totalprice") < 200000)).withColumn("o_totalprice", F.col("o_totalprice") + 1)


@query(f"SELECT * FROM ({_MONTHLY_SQL}) WHERE source_month NOT IN (DATE '1995-03-01', DATE '1995-05-01') UNION ALL {_CORRECTION_SQL}")
def snapshot_replace(spark, sf_dir):
    """All months; one is then replaced by its correction, twice, and another by nothing."""
    months = _monthly_orders(spark, sf_dir)
    table = Table(spark, f"{work_folder(spark)}/months", "source_month")
    table.overwrite(months)
    for _ in range(2):
        table.replace_partition(_correction(months), "1995-03-01")
    table.replace_partition(months.limit(0), "1995-05-01")
    return table.read()


@query(f"""
WITH old AS ({_MONTHLY_SQL}), new AS (SELECT * FROM ({_MONTHLY_SQL}) WHERE source_month <> DATE '1995-03-01' UNION ALL {_CORRECTION_SQL})
SELECT CASE WHEN old.o_orderkey IS NULL THEN 'insert' WHEN new.o_orderkey IS NULL THEN 'delete' WHEN old.o_totalprice = new.o_totalprice THEN 'keep' ELSE 'update' END AS action, count(*) AS n
FROM old FULL JOIN new ON old.o_orderkey = new.o_orderkey GROUP BY 1
""")
def snapshot_diff(spark, sf_dir):
    """What a correction changes, over all months."""
    months = _monthly_orders(spark, sf_dir)
    new = months.filter(F.col("source_month") != F.to_date(F.lit("1995-03-01"))).unionByName(_correction(months))
    return difference(months, new, ["o_orderkey"])


_DELIVERED = "c_acctbal >= 0 OR c_acctbal IS NULL", "c_acctbal < 4000"


@query(f"SELECT c_custkey, CASE WHEN {_DELIVERED[1]} THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer")
def upsert_latest(spark, sf_dir):
    """Two deliveries that overlap and make the whole table; rows of the second take the place of the first's."""
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    table = Table(spark, f"{work_folder(spark)}/customers")
    table.upsert(customers.filter(_DELIVERED[0]), ["c_custkey"])
    table.upsert(customers.filter(_DELIVERED[1]).withColumn("c_acctbal", F.col("c_acctbal") + 1), ["c_custkey"])
    return table.read()


@query(f"SELECT c_custkey, CASE WHEN {_DELIVERED[1]} THEN -c_acctbal ELSE c_acctbal END AS c_acctbal FROM customer")
def upsert_frames(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return upserted(customers.filter(_DELIVERED[0]), customers.filter(_DELIVERED[1]).withColumn("c_acctbal", -F.col("c_acctbal")), ["c_custkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 300000)")
def anti_join(spark, sf_dir):
    urgent = _read(spark, sf_dir, "orders").filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 300000))
    return without(_read(spark, sf_dir, "customer"), urgent.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"]).select("c_custkey")


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS pickup_month, o_orderpriority, count(*) AS n FROM orders
WHERE NOT (o_orderdate >= TIMESTAMP '1995-02-01' AND o_orderdate < TIMESTAMP '1995-03-01') GROUP BY 1, 2
""")
def gold_overwrite(spark, sf_dir):
    """All months of a mart, of which one is then overwritten by itself and another by an empty result."""
    mart = _read(spark, sf_dir, "orders").groupBy(month_of(F.col("o_orderdate")).alias("pickup_month"), "o_orderpriority").agg(F.count("*").alias("n"))
    table = Table(spark, f"{work_folder(spark)}/mart", "pickup_month")
    table.overwrite(mart)
    table.replace_partition(mart.filter(F.col("pickup_month") == F.to_date(F.lit("1995-01-01"))), "1995-01-01")
    table.replace_partition(mart.limit(0), "1995-02-01")
    return table.read()


@query("SELECT count(*) AS n_rows, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day, true AS several_files, 0 AS overlapping FROM lineitem")
def clustered_table(spark, sf_dir):
    """After clustering, no two files of the table have days in common."""
    table = Table(spark, f"{work_folder(spark)}/clustered")
    table.overwrite(_read(spark, sf_dir, "lineitem").select("l_orderkey", "l_shipdate"))
    table.clustered(["l_shipdate"], 4)
    files = table.read().groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high"))
    before = F.max("high").over(Window.orderBy("low", "file").rowsBetween(Window.unboundedPreceding, -1))  # as many rows as files
    overlapping = F.count_if(F.col("low") <= F.col("before")).cast("int")
    return files.withColumn("before", before).agg(F.sum("n").alias("n_rows"), F.min("low").alias("first_day"), F.max("high").alias("last_day"), (F.count("*") > 1).alias("several_files"), overlapping.alias("overlapping"))


# -- streams ----------------------------------------------------------------------------------------------------------

def _streamed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    folder = work_folder(spark)
    events = _read(spark, sf_dir, "events")
    for k in range(3):
        events.filter(F.col("event_id") % 3 == k).coalesce(1).write.parquet(f"{folder}/raw/source_month=2024-0{k + 1}/snapshot={str(k) * 64}")
    for _ in range(2):  # the second run finds nothing new
        bronze.ingest(bronze.read_stream(spark, f"{folder}/raw", events.schema), f"{folder}/bronze", f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/bronze"), folder


@query("SELECT event_type, CAST('2024-0' || (1 + event_id % 3) || '-01' AS DATE) AS source_month, count(*) AS n FROM events GROUP BY 1, 2")
def stream_bronze(spark, sf_dir):
    return _streamed(spark, sf_dir)[0].groupBy("event_type", "source_month").agg(F.count("*").alias("n"))


@query("SELECT repeat(CAST(event_id % 3 AS VARCHAR), 64) AS source_snapshot_id, true AS has_file, true AS has_time, count(*) AS n FROM events GROUP BY 1")
def bronze_lineage(spark, sf_dir):
    table = _streamed(spark, sf_dir)[0]
    return table.groupBy("source_snapshot_id", F.col("_source_file").contains("/raw/source_month=").alias("has_file"), F.col("_ingested_at").isNotNull().alias("has_time")).agg(F.count("*").alias("n"))


@query("SELECT repeat('1', 64) AS source_snapshot_id, count(*) + 1 AS rows_received, count(*) AS rows_found FROM events WHERE event_id % 3 = 1")
def stream_complete(spark, sf_dir):
    """Files of which the stream has another number of rows than was received."""
    table, _ = _streamed(spark, sf_dir)
    received = table.groupBy(F.col("_source_file").alias("uri")).agg((F.count("*") + F.max((F.col("source_month") == F.to_date(F.lit("2024-02-01"))).cast("int"))).alias("rows_received"))
    return bronze.complete(table, received).select(bronze.snapshot_in(F.col("uri")).alias("source_snapshot_id"), "rows_received", "rows_found")


# -- run state --------------------------------------------------------------------------------------------------------

#: A state log made of events: one row for each, tasks and statuses in turn, with a JSON payload.  SQL of both engines.
_LOG_SQL = """
SELECT concat('run-', CAST(event_id % 500 AS {string})) AS pipeline_run_id,
       CASE event_id % 4 WHEN 0 THEN 'source_landing' WHEN 1 THEN 'transform_silver' WHEN 2 THEN 'monitor' ELSE 'export_serving' END AS task_name,
       CASE WHEN user_id % 10 < 6 THEN 'SUCCESS' WHEN user_id % 10 < 8 THEN 'NO_DATA' ELSE 'FAILED' END AS status,
       concat('{{"snapshots":[{{"source_month":"2024-', CASE WHEN user_id % 12 < 9 THEN '0' ELSE '' END, CAST(user_id % 12 + 1 AS {string}), '-01","snapshot_id":"s', CAST(event_id % 7 AS {string}),
              '","uri":"u"}}],"cost_context":{{"duration_ms":', CAST(event_id % 1000 AS {string}), ',"environment":"dev","backfill":false}}}}') AS payload,
       ts + event_id * INTERVAL '1' MICROSECOND AS updated_at FROM events
"""
_LOG_DUCK = f"log AS ({_LOG_SQL.format(string='VARCHAR')})"
_SNAPSHOT_DUCK = f"""WITH {_LOG_DUCK}, snapshots AS (
    SELECT *, json_extract_string(payload, '$.snapshots[0].source_month') AS source_month, json_extract_string(payload, '$.snapshots[0].snapshot_id') AS snapshot_id FROM log),
published AS (SELECT source_month, max(updated_at) AS published_at, arg_max(snapshot_id, (updated_at, snapshot_id)) AS known FROM snapshots WHERE task_name = 'monitor' AND status = 'SUCCESS' GROUP BY 1),
landed AS (SELECT source_month, max(updated_at) AS landed_at FROM snapshots WHERE task_name = 'source_landing' AND status = 'SUCCESS' GROUP BY 1),
dirty AS (SELECT source_month FROM landed LEFT JOIN published USING (source_month) WHERE published_at IS NULL OR landed_at > published_at)"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = _LOG_SQL.format(string="STRING").replace("{", "{{").replace("}", "}}").replace("FROM events", "FROM {events}")
    return spark.sql(sql, events=_read(spark, sf_dir, "events"))


@query(f"{_SNAPSHOT_DUCK} SELECT source_month, known AS snapshot_id FROM published")
def latest_per_key(spark, sf_dir):
    return state.published(_log(spark, sf_dir)).select("source_month", "snapshot_id")


@query(f"{_SNAPSHOT_DUCK} SELECT source_month FROM dirty")
def dirty_months(spark, sf_dir):
    return state.dirty_months(_log(spark, sf_dir))


@query(f"""{_SNAPSHOT_DUCK}, candidates AS (SELECT source_month, min(snapshot_id) AS snapshot_id FROM snapshots GROUP BY 1)
SELECT source_month, snapshot_id, CASE WHEN known IS NULL OR known <> snapshot_id OR source_month IN (SELECT source_month FROM dirty) THEN 'process' ELSE 'skip' END AS action
FROM candidates LEFT JOIN published USING (source_month)""")
def plan_changed(spark, sf_dir):
    log = _log(spark, sf_dir)
    candidates = state.snapshots_of(log).groupBy("source_month").agg(F.min("snapshot_id").alias("snapshot_id"))
    return state.changed_plan(candidates, state.published(log).select("source_month", "snapshot_id"), state.dirty_months(log))


@query(f"""{_SNAPSHOT_DUCK}
SELECT DISTINCT pipeline_run_id FROM snapshots JOIN landed USING (source_month) WHERE task_name = 'source_landing' AND status = 'SUCCESS' AND updated_at < landed_at""")
def superseded(spark, sf_dir):
    return state.superseded(_log(spark, sf_dir))


@query(f"WITH {_LOG_DUCK} SELECT pipeline_run_id, task_name, status, updated_at FROM log WHERE task_name = 'source_landing' AND status IN ('SUCCESS', 'NO_DATA') ORDER BY updated_at DESC LIMIT 5")
def recent_runs(spark, sf_dir):
    rows = _log(spark, sf_dir).filter((F.col("task_name") == "source_landing") & F.col("status").isin("SUCCESS", "NO_DATA"))
    return rows.orderBy(F.col("updated_at").desc()).limit(5).select("pipeline_run_id", "task_name", "status", "updated_at")


@query(f"""
WITH {_LOG_DUCK}, recent AS (SELECT * FROM log WHERE task_name = 'source_landing' AND status IN ('SUCCESS', 'NO_DATA') ORDER BY updated_at DESC LIMIT 20),
marked AS (SELECT sum(CASE WHEN status <> 'NO_DATA' THEN 1 ELSE 0 END) OVER (ORDER BY updated_at DESC ROWS UNBOUNDED PRECEDING) AS breaks FROM recent)
SELECT count(*) FILTER (breaks = 0) AS streak FROM marked
""")
def no_data_streak(spark, sf_dir):
    return state.no_data_streak(_log(spark, sf_dir), 20)


@query(f"""
WITH {_LOG_DUCK} SELECT pipeline_run_id, task_name, status, updated_at, json_extract_string(payload, '$.cost_context.duration_ms') AS task_duration_ms,
json_extract_string(payload, '$.cost_context.environment') AS environment, json_extract_string(payload, '$.error') AS error FROM log
""")
def run_metrics(spark, sf_dir):
    return state.run_metrics(_log(spark, sf_dir)).select("pipeline_run_id", "task_name", "status", "updated_at", "task_duration_ms", "environment", "error")


@query(f"""
WITH {_LOG_DUCK} SELECT CASE WHEN max(updated_at) IS NULL OR max(updated_at) < TIMESTAMP '2024-02-03' - INTERVAL 26 HOUR THEN 'ALERT: no completed source check' ELSE 'OK' END AS freshness_status
FROM log WHERE task_name = 'source_landing' AND status IN ('SUCCESS', 'NO_DATA')
""")
def freshness_status(spark, sf_dir):
    return state.freshness(_log(spark, sf_dir), F.lit("2024-02-03").cast("timestamp_ntz"))


_DELIVERIES = "SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS source_month, count(*) AS rows_received FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1"


@query(f"""{_SNAPSHOT_DUCK}, deliveries AS ({_DELIVERIES}), months AS (SELECT source_month FROM published UNION SELECT source_month FROM deliveries),
newest AS (SELECT max(CAST(source_month AS DATE)) AS m, count(*) FILTER (source_month IN ('2024-12-01', '2025-01-01')) AS due FROM months),
recent AS (SELECT * FROM log WHERE task_name = 'source_landing' AND status IN ('SUCCESS', 'NO_DATA') ORDER BY updated_at DESC LIMIT 20),
streak AS (SELECT count(*) FILTER (breaks = 0) AS n FROM (SELECT sum(CASE WHEN status <> 'NO_DATA' THEN 1 ELSE 0 END) OVER (ORDER BY updated_at DESC ROWS UNBOUNDED PRECEDING) AS breaks FROM recent)),
found AS (
    SELECT 'NO_DATA' AS kind, '2025-04-15' AS scope FROM streak WHERE n >= 1 UNION ALL
    SELECT 'SOURCE_MISSING', '2025-04-15' FROM newest WHERE m IS NULL UNION ALL
    SELECT 'SOURCE_FRESHNESS', CAST(m AS VARCHAR) FROM newest WHERE DATE '2025-04-15' - m > 100 UNION ALL
    SELECT 'SOURCE_COMPLETENESS', '2025-04-15' FROM newest WHERE m IS NOT NULL AND due < 2 UNION ALL
    SELECT 'SOURCE_ROWS', source_month FROM deliveries WHERE rows_received < 180)
SELECT kind, scope, sha256('dev|' || kind || '|' || scope) AS fingerprint FROM found""")
def monitor_checks(spark, sf_dir):
    """The breaches of a run without data, after what the log says of earlier ones; the months of orders are its deliveries."""
    log = _log(spark, sf_dir)
    setting = config.DEFAULTS | {"environment": "dev", "processing_date": "2025-04-15", "late_arrival_months": 3}
    setting["monitoring"] = setting["monitoring"] | {"max_no_data_runs": 1, "min_snapshot_rows": 180}
    deliveries = _read(spark, sf_dir, "orders").filter("o_orderdate IS NOT NULL").groupBy(month_of(F.col("o_orderdate")).cast("string").alias("source_month")).agg(F.count("*").alias("rows_received"))
    return monitor.source_breaches(state.published(log), deliveries, state.no_data_streak(log, 20), setting)


@query("""
SELECT event_id, sha256(concat_ws('|', environment, kind, scope)) AS fingerprint, sha256(concat_ws('|', environment, kind, scope)) IS DISTINCT FROM
       lag(sha256(concat_ws('|', environment, kind, scope))) OVER (PARTITION BY environment ORDER BY event_id) AS alerts
FROM (SELECT event_id, 'env' || CAST(user_id % 50 AS VARCHAR) AS environment, event_type AS kind, CAST(user_id % 2 AS VARCHAR) AS scope FROM events)
""")
def alert_dedup(spark, sf_dir):
    alerts = _read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("env"), (F.col("user_id") % 50).cast("string")).alias("environment"), F.col("event_type").alias("kind"), (F.col("user_id") % 2).cast("string").alias("scope"))
    return config.new_alerts(alerts, [F.col("event_id")]).select("event_id", "fingerprint", "alerts")


@query("""
SELECT 'r1' AS pipeline_run_id, event_type AS task_name, count(*) AS rows_in, count(*) FILTER (value >= 10) AS rows_out, count(*) FILTER (value < 10) AS rows_quarantined,
       CASE WHEN count(*) FILTER (value < 10) > 0 THEN 'SUCCESS' ELSE 'NO_DATA' END AS status FROM events GROUP BY 2
""")
def run_log(spark, sf_dir):
    """A row of the run log for each type of event, appended one by one."""
    table, moment = Table(spark, f"{work_folder(spark)}/log"), dt.datetime(2024, 1, 1, tzinfo=dt.UTC)
    counts = _read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") < 10).alias("low"))
    for r in counts.collect():  # a handful of types
        state.log_run(table, ("r1", r["event_type"], "b", "s", r["n"], r["n"] - r["low"], 0, r["low"], "SUCCESS" if r["low"] else "NO_DATA", moment, moment))
    return table.read().select("pipeline_run_id", "task_name", "rows_in", "rows_out", "rows_quarantined", "status")


# -- publication ------------------------------------------------------------------------------------------------------

_ORDERS_MART_SQL = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS pickup_month, o_orderpriority AS k, count(*) AS trip_count, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(20,2)) AS total_revenue
FROM orders GROUP BY 1, 2
"""


def _orders_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    revenue = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(20,2)")
    return _read(spark, sf_dir, "orders").groupBy(month_of(F.col("o_orderdate")).alias("pickup_month"), F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("trip_count"), revenue.alias("total_revenue"))


@query(f"""
WITH mart AS ({_ORDERS_MART_SQL}), actual AS (SELECT pickup_month AS month, CAST(sum(trip_count) AS BIGINT) AS trips FROM mart WHERE pickup_month <> DATE '1995-04-01' GROUP BY 1),
expected AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) + CAST(month(o_orderdate) = 2 AS INTEGER) AS trips FROM orders GROUP BY 1, month(o_orderdate))
SELECT month FROM expected FULL JOIN actual USING (month) WHERE expected.trips IS DISTINCT FROM actual.trips
""")
def reconcile_marts(spark, sf_dir):
    """Months whose trips differ between the fact and the mart; Februaries are off by one, and a month is missing."""
    months = _read(spark, sf_dir, "orders").groupBy(month_of(F.col("o_orderdate")).alias("month")).agg(F.count("*").alias("n"))
    expected = months.select("month", (F.col("n") + (F.month("month") == 2).cast("int")).alias("trips"))
    actual = _orders_mart(spark, sf_dir).filter(F.col("pickup_month") != F.to_date(F.lit("1995-04-01"))).groupBy(F.col("pickup_month").alias("month")).agg(F.sum("trip_count").alias("trips"))
    return publish.mismatches(expected, actual, ["month"], ["trips"])


@query(f"SELECT 'orders' AS mart, pickup_month AS month, count(*) AS n_rows, CAST(sum(trip_count) AS BIGINT) AS trips, CAST(sum(total_revenue) AS DECIMAL(20,2)) AS revenue FROM ({_ORDERS_MART_SQL}) GROUP BY 2")
def publish_reconcile(spark, sf_dir):
    """All months are published, one of them again by a later run; metrics of what serving then shows."""
    folder, mart = work_folder(spark), _orders_mart(spark, sf_dir)

    def run(name: str, frame: DataFrame) -> None:
        exports = publish.export_months(frame, f"{folder}/exports", "orders", "pickup_month", name)
        metrics = [{"mart": "orders", "month": str(r["month"]), "rows": r["n_rows"], "trips": r["trips"]} for r in publish.month_metrics(frame, "orders").collect()]  # a row for each month
        given = publish.handoff(name, exports, metrics, ["orders"])
        publish.publish(spark, given, f"{folder}/serving")
        publish.reconcile(spark, given, f"{folder}/serving")

    run("r1", mart.withColumn("trip_count", F.col("trip_count") + (F.col("pickup_month") == F.to_date(F.lit("1995-03-01"))).cast("int")))
    run("r2", mart.filter(F.col("pickup_month") == F.to_date(F.lit("1995-03-01"))))
    return publish.month_metrics(publish.serving(spark, f"{folder}/serving", "orders"), "orders")


@query(f"SELECT mart, CAST(pickup_month AS VARCHAR) AS month, count(*) AS n_rows FROM ({_ORDERS_MART_SQL}), (VALUES ('orders')) AS v(mart) GROUP BY 1, 2")
def export_manifest(spark, sf_dir):
    """The rows that each exported month has where its manifest says it is."""
    folder, mart = work_folder(spark), _orders_mart(spark, sf_dir)
    places = {e["uri"]: (e["mart"], e["month"]) for e in publish.export_months(mart, folder, "orders", "pickup_month", "v1")}
    uri = F.regexp_extract(F.col("_metadata.file_path"), r"(/v1/orders/month=[^/]*)/", 1)
    found = spark.read.parquet(*places).select(uri.alias("place")).groupBy("place").agg(F.count("*").alias("n_rows"))
    told = spark.createDataFrame([(u[u.index("/v1/") :], *named) for u, named in places.items()], "place string, mart string, month string")
    return found.join(told, "place").select("mart", "month", "n_rows")


# queries of a module of their own, which takes query() from here
from tidemark.plans import catalogue_upkeep  # noqa: E402, F401
