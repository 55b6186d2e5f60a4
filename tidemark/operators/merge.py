"""Keyed merges: replacement, upsert and deletion expressed on plain frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import newest_per_key


def replace_by_key(current: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``updates`` replace rows of ``current`` with the same key; new keys are added."""
    kept = current.join(updates.select(*key), list(key), "left_anti")
    return kept.unionByName(updates)


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], newest_first: list | None = None) -> DataFrame:
    """Like ``replace_by_key`` for a source that may repeat a key: only its newest row counts."""
    if newest_first:
        source = newest_per_key(source, list(key), newest_first)
    else:
        source = source.dropDuplicates(list(key))
    return replace_by_key(target, source, key)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; an unknown answer keeps the row."""
    return df.where(~F.coalesce(predicate, F.lit(False)))
