"""Views that a query uses many times are computed once, and what is wide is not dealt out by its tenants."""

import os
import re

import pytest

import __spark_entry__  # noqa: F401
from harness.registry import QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(("name", "scans"), [("mart_dataset", 3), ("mart_dataset_extended", 3), ("mart_stream", 4), ("mart_api", 2)])
def test_catalogue_scans(spark, name, scans):
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan(QUERIES[name](spark, SF)))) <= scans


@pytest.mark.parametrize("name", ["mart_dataset", "mart_dataset_extended", "mart_stream"])
def test_tenants_meet_narrow_rows(spark, name):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "hashpartitioning(idtenant#" not in plan(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
