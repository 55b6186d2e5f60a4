"""Incremental exports of which nothing is pending."""

import pytest

import __spark_entry__  # noqa: F401
from harness.registry import QUERIES


@pytest.mark.parametrize("name", ["incremental_export", "incremental_stream"])
def test_nothing_pending(spark, tmp_path, name):
    # three early errors of a dataset switch its incremental export off
    events = spark.range(3).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 01:00:00' AS ts", "5L AS user_id", "'error' AS event_type", "1.5D AS value", "'p' AS props"
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    assert QUERIES[name](spark, str(tmp_path)).collect() == []
