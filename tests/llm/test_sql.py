"""Queries of the training-text operators against their reference SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from martwright.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "conversations", "embeddings", "pages"):
        connection.sql(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_reference_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    relation = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(relation.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(relation.columns, relation.fetchall())
