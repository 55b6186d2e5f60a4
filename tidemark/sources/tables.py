"""Scans of lake tables driven by dataset descriptors."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fieldtypes import document_columns


def scan_dataset(
    lake: DataFrame, fields: Iterable[tuple[str, str]], dataset_id: int, version: int, family: str,
    with_row_number: bool = True,
) -> DataFrame:
    """Lake rows as serving documents: only the descriptor's columns are read."""
    columns = document_columns(fields, dataset_id, version, family)
    return lake.select(*([F.col("sparkuniqueid")] if with_row_number else []), *columns)


def lake_table(spark: SparkSession, schema: str, table: str) -> DataFrame:
    return spark.table(f"`{schema}`.`{table}`")
