"""Alignment state: the last exported object id of every dataset and version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.objectid import FIRST_ID, NEVER_ID
from tidemark.operators.merge import replace_by_key
from tidemark.sinks.tables import StateTable

STATE_KEYS = ["iddataset", "datasetversion"]
STATE_SCHEMA = T.StructType(
    [
        T.StructField("iddataset", T.LongType()),
        T.StructField("datasetversion", T.LongType()),
        T.StructField("last_id", T.StringType()),
    ]
)


# state kept per tenant by older jobs
TENANT_KEYS = ["tenantcode"]
TENANT_SCHEMA = T.StructType([T.StructField("tenantcode", T.StringType()), T.StructField("last_id", T.StringType())])


def state_table(spark: SparkSession, path: str, schema: T.StructType = STATE_SCHEMA) -> StateTable:
    return StateTable(spark, path, schema)


def last_ids(wanted: DataFrame, state: DataFrame, keys: Sequence[str] = STATE_KEYS) -> DataFrame:
    """The datasets (or tenants) with their last exported id, all zeros for those never exported."""
    one = state.groupBy(*keys).agg(F.max("last_id").alias("last_id"))
    joined = wanted.join(one, list(keys), "left")
    return joined.withColumn("last_id", F.coalesce("last_id", F.lit(FIRST_ID)))


def merge_state(state: DataFrame, updates: DataFrame, keys: Sequence[str] = STATE_KEYS) -> DataFrame:
    """New ids replace the stored ones, datasets seen for the first time are added."""
    return replace_by_key(state, updates.select(*keys, "last_id"), keys)


def advance_state(state: DataFrame, found: DataFrame) -> DataFrame:
    """Move the state forward to the highest ids found, never back: what is switched off meanwhile stays so."""
    old = state.withColumnRenamed("last_id", "_old")
    ahead = found.join(old, STATE_KEYS, "left").withColumn("last_id", F.greatest("last_id", "_old"))
    return merge_state(state, ahead)


def stop_incremental(datasets: DataFrame) -> DataFrame:
    """State rows that switch incremental export off after a full export or publish."""
    return datasets.select(*STATE_KEYS).distinct().withColumn("last_id", F.lit(NEVER_ID))
