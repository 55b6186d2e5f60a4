"""Text lists and key/value pivots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def comma_list(df: DataFrame, key: Sequence[str], value: str, name: str, *others: Column) -> DataFrame:
    """Sorted, comma separated list of the distinct values of each key, with other aggregates of the key, if any.

    Duplicates are dropped by the map-side combine, so a key gathers its distinct names only: the text it returns.
    """
    return df.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias(name), *others)


def pivot_params(df: DataFrame, key: str, param: str, value: str, wanted: Sequence[str]) -> DataFrame:
    """Key/value rows to one column per wanted parameter; naming them avoids a job that looks for them."""
    return df.where(F.col(param).isin(*wanted)).groupBy(key).pivot(param, list(wanted)).agg(F.max(value))
