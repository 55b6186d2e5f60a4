"""Every registered query against its oracle on DuckDB, at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from harness.registry import ORACLES, QUERIES
from harness.views import TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    found = QUERIES[name](spark, SF)
    spark_columns, spark_rows = table(found.columns, found.collect())
    answer = duck.execute(ORACLES[name])
    columns, expected = table([c[0] for c in answer.description], answer.fetchall())
    assert spark_columns == columns
    assert spark_rows == expected


def test_registered():
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["tenant_sizes_total", "mart_dataset", "join_suffix", "join_case_insensitive", "odata_call_pairs"])
def test_no_nested_loops(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
