"""Newest version per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_versions(df: DataFrame, key: str, version: str) -> DataFrame:
    """Rows that carry the highest version of their key.

    The highest versions are aggregated (combined before the shuffle) and joined back. The join runs on key and
    version: it gets its own shuffle on both sides, which lets Spark split an uneven key, unless the rows lie in
    buckets of key and version, which are then not dealt out again. A missing key has no versions.
    """
    newest = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.max(version).alias("_version"))
    return df.join(newest, (F.col(key) == F.col("_key")) & (F.col(version) == F.col("_version")), "inner").select(*df.columns)


def newest_per_key(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """One row per key, the first under the given order; each map task sends at most one row per key."""
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")
