"""Joins shaped for uneven keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_many(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left outer join of a small side with a large one whose keys may be very uneven.

    Spark can neither broadcast nor split the sides of an outer join that way round, so the join is written as
    its two parts: an inner join, where both are possible, and the left rows without a partner, found against
    the distinct right keys. Left rows with a null key have no partner and skip both shuffles.
    """
    on = list(on)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    others = [c for c in right.columns if c not in on]
    matched = left.join(right, on, "inner").select(*left.columns, *others)

    def padded(rows: DataFrame) -> DataFrame:
        nulls = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in others]
        return rows.select(*left.columns, *nulls)

    keyed = left.where(has_key)
    lonely = keyed.join(right.select(*on).where(has_key).distinct(), on, "left_anti")
    return matched.unionByName(padded(lonely)).unionByName(padded(left.where(~has_key)))


def join_ignoring_case(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]], how: str) -> DataFrame:
    """Equi-join on upper-cased text columns; pairs are (left column, right column)."""
    return left.join(right, _all([F.upper(left[a]) == F.upper(right[b]) for a, b in pairs]), how)


def join_on_code_suffix(
    ids: DataFrame, id_column: str, id_version: str, coded: DataFrame, code_column: str, code_version: str
) -> DataFrame:
    """Inner join of numeric ids with codes ending in ``_<id>``, on the id and the version.

    The number after the last underscore is extracted first, so this is a plain equi-join.
    """
    tail = F.regexp_extract(coded[code_column], r"_([0-9]+)$", 1).try_cast("bigint")
    keyed = coded.withColumn("_code_id", tail).where(F.col("_code_id").isNotNull())
    same_id = ids[id_column].cast("bigint") == keyed["_code_id"]
    return ids.join(keyed, same_id & (ids[id_version] == keyed[code_version]), "inner").drop("_code_id")


def join_all(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join chain over one shared key that is unique in every frame."""
    return reduce(lambda a, b: a.join(b, key, "left"), frames)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)
