"""Every registered query against its reference SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from martwright.catalog.adapters import BASE_TABLES
from martwright.catalog.oracle import ORACLE
from martwright.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_reference_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    relation = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(relation.columns, relation.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
