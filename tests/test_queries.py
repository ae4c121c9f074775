"""Registered queries against their SQL text, on the smallest given tables.

The events graph runs the same operators and is left to the driver's own check.
"""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("customer", "events", "orders")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="given tables not found")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(registered.graph_queries()) == set(registered.graph_sql())
    assert set(registered.graph_queries()) <= set(registered.queries())


@pytest.mark.parametrize("name", [n for n in registered.graph_queries() if not n.endswith("_events")])
def test_query_equals_sql(spark, sql, name):
    found = registered.graph_queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    relation = sql.sql(registered.graph_sql()[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    expected = Counter(relation.project(picked).fetchall())
    assert Counter(map(tuple, found.select(columns).collect())) == expected


def test_entry(spark):
    assert registered.entry(spark).columns == ["closed_paths", "triangles"]
