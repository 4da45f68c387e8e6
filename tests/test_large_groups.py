"""Queries against their SQL where a group has more rows than an approximation counts one by one."""

import duckdb
from pyspark.sql import functions as F

from tidemark.plans import catalogue


def test_fare_integrity_of_large_groups(spark, tmp_path):
    lines = spark.range(80_000).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 10).alias("l_partkey"), F.lit(2.0).alias("l_quantity"), (F.xxhash64("id") % 10_000_000 / 100).alias("l_extendedprice"),
        F.expr("timestamp_ntz '1996-01-05 00:00:00' + make_interval(0, 0, 0, int(id % 3 = 0))").alias("l_shipdate"),
    )
    lines.repartition(7).write.parquet(f"{tmp_path}/lineitem.parquet")
    # parts of either kind, one without a size, one too few
    spark.range(9).select(F.col("id").alias("p_partkey"), F.expr("if(id = 8, null, if(id < 2, 45, 5))").cast("int").alias("p_size")).write.parquet(f"{tmp_path}/part.parquet")
    duck = duckdb.connect()
    for table in ("lineitem", "part"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    want = duck.sql(catalogue.ORACLE_SQL["fare_integrity"])
    got = catalogue.QUERIES["fare_integrity"](spark, str(tmp_path)).select(*want.columns)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
