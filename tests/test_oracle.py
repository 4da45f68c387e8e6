"""Every query against its SQL, at the smallest scale."""

import datetime as dt
import decimal

import duckdb
import pytest

from tidemark.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, float) and value != value:
        return "nan"
    return str(value) if isinstance(value, (decimal.Decimal, dt.date)) else value


def rows(columns, found):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted([tuple(plain(row[i]) for i in order) for row in found], key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_every_query_has_sql():
    assert catalogue.QUERIES.keys() == catalogue.ORACLE_SQL.keys()
