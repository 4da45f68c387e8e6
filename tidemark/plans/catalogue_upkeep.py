"""More named queries: layouts, incremental rollups, sketches, skew, content digests, event time.  The module catalogue registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import clustering, digests, quantiles, skew
from tidemark.operators.rollup import Rollup
from tidemark.operators.tables import Table, work_folder
from tidemark.plans.catalogue import _MONEY, _read, query
from tidemark.streaming import events as stream

# -- layouts ----------------------------------------------------------------------------------------------------------

_FILES = 64


@query("""
WITH parts AS (SELECT max(p_partkey) // 20 AS most FROM part)
SELECT 'l_shipdate' AS filter, count(*) AS n_rows, true AS morton_skips, true AS linear_skips FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1997-03-01'
UNION ALL SELECT 'l_partkey', count(*), true, false FROM lineitem, parts WHERE l_partkey >= 0 AND l_partkey < most
""")
def zorder_skipping(spark, sf_dir):
    """A table in the order of a Morton curve, and the same in that of its columns: what each finds for filters on either column,
    and whether a scan is spared half of the files by their statistics."""
    items = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    columns, folder = ["l_shipdate", "l_partkey"], work_folder(spark)
    linear, morton = (Table(spark, f"{folder}/{name}") for name in ("linear", "morton"))
    linear.overwrite(items.repartitionByRange(_FILES, *columns).sortWithinPartitions(*columns))
    morton.overwrite(items)
    morton.rewrite(lambda rows: clustering.z_ordered(rows, columns, _FILES))
    most = _read(spark, sf_dir, "part").agg(F.floor(F.max("p_partkey") / 20).alias("most")).first()["most"]
    ranges = {"l_shipdate": [F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-03-01")], "l_partkey": [F.lit(0), F.lit(most)]}
    out = []
    for column, (low, high) in ranges.items():
        found = morton.read().filter((F.col(column) >= low) & (F.col(column) < high)).agg(F.count("*").alias("n_rows"))
        spared = [
            clustering.extents(table.read(), columns).agg((2 * F.count_if(clustering.read_by(column, low, high)) <= F.count("*")).alias(name))
            for table, name in ((morton, "morton_skips"), (linear, "linear_skips"))
        ]
        out.append(found.crossJoin(spared[0]).crossJoin(spared[1]).select(F.lit(column).alias("filter"), "n_rows", "morton_skips", "linear_skips"))  # a row each
    return out[0].union(out[1])


# -- incremental rollups ----------------------------------------------------------------------------------------------

_DAILY_SQL = "SELECT event_id, ts, event_type, value, CAST(ts AS DATE) AS day FROM events"
_CORRECTED_SQL = f"""
SELECT event_id, ts, event_type, CASE WHEN day = DATE '2024-01-05' THEN value + 1 ELSE value END AS value, day FROM ({_DAILY_SQL})
WHERE day <> DATE '2024-01-07' AND NOT (day = DATE '2024-01-05' AND event_type = 'error')
"""


def _daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value", F.col("ts").cast("date").alias("day"))


def hourly_rollup(source: Table, target: Table) -> Rollup:
    """Events by day, hour and type."""
    keys = {"day": F.col("day"), "hour_of_day": F.hour("ts").cast("int"), "event_type": F.col("event_type")}
    return Rollup(source, target, keys, {"total": (F.col("value").cast(_MONEY), "decimal(20,2)")})


@query(f"""
SELECT day, CAST(hour(ts) AS INTEGER) AS hour_of_day, event_type, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total FROM ({_CORRECTED_SQL}) GROUP BY 1, 2, 3
""")
def rollup_incremental(spark, sf_dir):
    """A rollup that follows its table through a load, an append, a corrected day, a removed one and a new layout of a third."""
    events, folder = _daily_events(spark, sf_dir), work_folder(spark)
    source = Table(spark, f"{folder}/events", "day")
    rollup = hourly_rollup(source, Table(spark, f"{folder}/hourly", "day"))
    late = F.col("day") >= F.to_date(F.lit("2024-01-20"))
    source.overwrite(events.filter(~late))
    rollup.refresh()
    source.append(events.filter(late))
    rollup.refresh()
    fifth = events.filter((F.col("day") == F.to_date(F.lit("2024-01-05"))) & (F.col("event_type") != "error"))
    source.replace_partition(fifth.withColumn("value", F.col("value") + 1), "2024-01-05")
    source.replace_partition(events.limit(0), "2024-01-07")
    source.rewrite(lambda rows: rows.repartition(2), ["2024-01-09"])
    for _ in range(2):  # the second finds nothing to do
        rollup.refresh()
    return rollup.target.read()


# -- quantiles of ranges ----------------------------------------------------------------------------------------------

@query("""
SELECT event_type, count(value) AS n, true AS within FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21' GROUP BY 1
""")
def p95_merged(spark, sf_dir):
    """The p95 of each type over some days, from sketches that are stored by day, and whether its rank is near 0.95."""
    events, value = _daily_events(spark, sf_dir), F.col("value")
    table = Table(spark, f"{work_folder(spark)}/sketches", "day")
    table.overwrite(quantiles.quantile_sketches(events, ["day", "event_type"], value))
    days = [f"2024-01-{d:02}" for d in range(5, 21)]
    merged = quantiles.merged_sketches(table.read(days), ["event_type"]).select("event_type", quantiles.sketched_quantile(0.95).alias("p95"))
    inside = events.filter(F.col("day").between(F.to_date(F.lit(days[0])), F.to_date(F.lit(days[-1]))))
    found = quantiles.rank_error(inside, ["event_type"], value, merged, "p95", 0.95)
    return found.select("event_type", "n", (F.col("error") <= 3 * quantiles.RANK_ERROR).alias("within"))


# -- skew -------------------------------------------------------------------------------------------------------------

#: Two fifths of the events are given to one user, and a seventh of the rest to none.
_SKEWED_SQL = "SELECT event_id, ts, value, CASE WHEN event_id % 5 < 2 THEN 1 WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS user_id FROM events"


def _skewed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    user = F.when(e % 5 < 2, F.lit(1).cast("long")).when(e % 7 == 0, F.lit(None)).otherwise(F.col("user_id"))
    return _read(spark, sf_dir, "events").select("event_id", "ts", "value", user.alias("user_id"))


@query(f"SELECT user_id, count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS days FROM ({_SKEWED_SQL}) GROUP BY 1")
def skew_distinct(spark, sf_dir):
    """Distinct days by user; only the users that hold very many events are dealt into shares."""
    partial = {"__n": F.count("*"), "__days": F.collect_set(F.col("ts").cast("date"))}
    final = {"n": F.sum("__n"), "days": F.size(F.array_distinct(F.flatten(F.collect_list("__days")))).cast("long")}
    return skew.skewed_aggregate(_skewed_events(spark, sf_dir), ["user_id"], ["event_id"], partial, final)


@query(f"""
SELECT c_nationkey AS zone_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total FROM ({_SKEWED_SQL}) LEFT JOIN customer ON user_id = c_custkey GROUP BY 1
""")
def skew_join(spark, sf_dir):
    """Events with the nation of their user; the customers of heavy users are repeated for each share of these."""
    customers = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("zone_id"))
    joined = skew.skewed_join(_skewed_events(spark, sf_dir), customers, ["user_id"], ["event_id"], "left")
    return joined.groupBy("zone_id").agg(F.count("*").alias("n"), F.sum(F.col("value").cast(_MONEY)).cast("decimal(20,2)").alias("total"))


# -- content ----------------------------------------------------------------------------------------------------------

_ROWS_SQL = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"
#: A copy in which some orders cost more, are missing, are there twice, or have their customer from another.
_COPY_SQL = f"""
SELECT o_orderkey, CASE WHEN o_orderkey = 301 THEN (SELECT o_custkey FROM orders WHERE o_orderkey = 302) WHEN o_orderkey = 302 THEN (SELECT o_custkey FROM orders WHERE o_orderkey = 301) ELSE o_custkey END AS o_custkey,
       CASE WHEN o_orderkey = 310 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM ({_ROWS_SQL}) WHERE o_orderkey <> 777
UNION ALL {_ROWS_SQL} WHERE o_orderkey = 320
"""


@query(f"""
SELECT o_orderkey, o_custkey, o_totalprice, CAST(sum(a) AS BIGINT) AS n_a, CAST(sum(b) AS BIGINT) AS n_b FROM (SELECT *, 1 AS a, 0 AS b FROM ({_ROWS_SQL}) UNION ALL SELECT *, 0, 1 FROM ({_COPY_SQL}))
GROUP BY ALL HAVING sum(a) <> sum(b)
""")
def content_diff(spark, sf_dir):
    """Rows in which a copy differs, found by digests of ranges of keys."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    copy = spark.sql(_COPY_SQL.replace("FROM orders", "FROM {o}"), o=orders)
    return digests.row_differences(orders, copy, "o_orderkey")


@query("""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS pickup_month, count(*) AS n_a, CAST(sum(CASE WHEN o_orderkey % 211 = 0 THEN 0 ELSE 1 END) AS BIGINT) AS n_b
FROM orders GROUP BY 1 HAVING sum(CASE WHEN o_orderkey % 211 IN (0, 1) THEN 1 ELSE 0 END) > 0
""")
def digest_months(spark, sf_dir):
    """Months in which a copy has lost rows or has changed ones."""
    orders = _read(spark, sf_dir, "orders").withColumn("pickup_month", F.trunc("o_orderdate", "month"))
    copy = orders.filter("o_orderkey % 211 <> 0").withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderkey") % 211 == 1, 1).otherwise(0))
    return digests.unequal(digests.digests(orders, ["pickup_month"]), digests.digests(copy, ["pickup_month"]), ["pickup_month"])


# -- event time -------------------------------------------------------------------------------------------------------

_DAY_OF = "CAST(ts AS DATE)"


def _delivered(spark: SparkSession, sf_dir: str, parts: list[str], folder: str, columns: list[str], late: bool = False) -> DataFrame:
    """Events as a stream: a file for each condition, in that order, one file at a time."""
    events = _read(spark, sf_dir, "events").select(*columns)
    for condition in parts:
        rows = events.filter(condition)
        if late and condition == parts[-1]:  # of the first day, under other names, weeks later
            rows = rows.unionByName(events.filter(f"{_DAY_OF} = DATE '2024-01-01'").withColumn("event_id", F.col("event_id") + 1_000_000_000_000))
        rows.coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)


_WEEKS = [f"{_DAY_OF} < DATE '2024-01-10'", f"{_DAY_OF} >= DATE '2024-01-10' AND {_DAY_OF} < DATE '2024-01-20'", f"{_DAY_OF} >= DATE '2024-01-20'"]


@query("""
WITH marked AS (SELECT *, CASE WHEN ts <= lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS starts FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM marked),
whole AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 6 HOUR AS session_end, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(10,2))) AS DECIMAL(20,2)) AS total FROM numbered GROUP BY user_id, session)
SELECT * FROM whole WHERE session_end <= date_trunc('milliseconds', (SELECT max(ts) FROM events)) - INTERVAL 2 DAY
""")
def stream_sessions(spark, sf_dir):
    """Sessions of users, as a stream of three files tells them: those whose end the watermark has passed."""
    folder = work_folder(spark)
    rows = _delivered(spark, sf_dir, _WEEKS, f"{folder}/raw", ["event_id", "ts", "user_id", "value"])
    found = stream.sessions(rows, ["user_id"], "ts", "6 hours", "2 days", {"n": F.count("*"), "total": F.sum(F.col("value").cast(_MONEY)).cast("decimal(20,2)")})
    stream.run_to_end(found, f"{folder}/out", f"{folder}/checkpoint")
    told = spark.read.schema(found.schema).parquet(f"{folder}/out")
    return told.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


_AGAIN = [_WEEKS[0], _WEEKS[1].replace("01-10", "01-09", 1), _WEEKS[2].replace("01-20", "01-19", 1)]


@query(f"""
SELECT 'kept' AS kind, event_type, count(*) AS n FROM events GROUP BY 2 UNION ALL
SELECT 'late', NULL, count(*) FROM events WHERE {_DAY_OF} = DATE '2024-01-01'
""")
def stream_once(spark, sf_dir):
    """Each file but the first repeats the last day of the one before; the last one also has rows that are weeks late."""
    folder = work_folder(spark)
    rows = _delivered(spark, sf_dir, _AGAIN, f"{folder}/raw", ["event_id", "ts", "event_type"], late=True)
    late = stream.run_to_end(stream.once(rows, ["event_id"], "ts", "2 days"), f"{folder}/out", f"{folder}/checkpoint")
    kept = spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count("*").alias("n")).select(F.lit("kept").alias("kind"), "event_type", "n")
    return kept.unionByName(spark.createDataFrame([("late", None, late)], kept.schema))


@query("""
SELECT v.user_id, v.event_id AS view_id, p.event_id AS purchase_id, v.ts AS first_at, p.ts AS then_at FROM events v JOIN events p ON v.user_id = p.user_id
WHERE v.event_type = 'view' AND p.event_type = 'purchase' AND p.ts >= v.ts AND p.ts <= v.ts + INTERVAL 24 HOUR
""")
def stream_followed(spark, sf_dir):
    """Purchases within a day of a view by the same user, joined as two streams."""
    folder, columns = work_folder(spark), ["event_id", "ts", "user_id", "event_type"]
    rows = _delivered(spark, sf_dir, _WEEKS, f"{folder}/raw", columns)
    views = rows.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("first_at"))
    bought = rows.filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("then_at"))
    found = stream.followed(views, bought, ["user_id"], "24 HOURS", "2 days")
    stream.run_to_end(found, f"{folder}/out", f"{folder}/checkpoint")
    told = spark.read.schema(found.schema).parquet(f"{folder}/out")
    return told.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("first_at", "then_at")})
