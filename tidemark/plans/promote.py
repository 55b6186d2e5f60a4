"""Promotion: source tables copied into lake tables with object ids and dense row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.objectid import id_from_time
from tidemark.operators.rowid import with_dense_row_id
from tidemark.sinks.tables import replace_table


# layout of the 64 low bits of an object id: the id space above, the row number below
_ROW_BITS = 40
_SPACES = 1 << (64 - _ROW_BITS)


def promoted_rows(
    source: DataFrame, columns: Sequence[str], load_time: str, add_ids: bool = True, add_row_number: bool = True,
    order_by: list[str | Column] | None = None, id_space: int = 0,
) -> DataFrame:
    """The dataset's columns plus ``bda_id``, ``bda_origin`` and ``sparkuniqueid``.

    The object id joins the load time, the id space and the row number, so that the same load gives the same ids.
    Tables loaded in the same second need different id spaces; the dataset's number serves for that.
    """
    if not 0 <= id_space < _SPACES:
        raise ValueError(f"id_space must be below {_SPACES}")
    rows = source.select(*columns)
    if not (add_ids or add_row_number):
        return rows
    numbered = with_dense_row_id(rows, order_by=order_by)
    out = [F.col(f"`{c}`") for c in columns]
    if add_ids:
        number = F.col("sparkuniqueid")
        number = F.when(number < (1 << _ROW_BITS), number).otherwise(F.raise_error(F.lit(f"more than {1 << _ROW_BITS} rows share an id space")))
        space = id_space << _ROW_BITS
        low = number.bitwiseOR(F.lit(space - (1 << 64) if space >> 63 else space))  # the upper half is negative as a bigint
        moment = F.lit(load_time).cast("timestamp")
        out += [id_from_time(moment, low).alias("bda_id"), F.lit("datalake").alias("bda_origin")]
    if add_row_number:
        out.append(F.col("sparkuniqueid"))
    return numbered.select(*out)


def promote(source: DataFrame, columns: Sequence[str], target_table: str, load_time: str, root: str | None = None, **options) -> int:
    """Replace the lake table by the promoted rows, its versions below ``root``; returns the row count."""
    return replace_table(promoted_rows(source, columns, load_time, **options), target_table, root).count()
