"""CSV scans with declared, all-text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# A null marker no file contains, so that an empty unquoted value is null and a quoted one is empty text.
_NULL_MARK = "\x00"


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


def read_raw_csv(
    spark: SparkSession, paths: str | list[str], columns: Sequence[str], multi_line: bool = False, recursive: bool = False
) -> DataFrame:
    """Exported CSV files with a header, every value as text; null and empty text stay apart.

    Values may hold line breaks only with ``multi_line``, which costs the ability to split one file among tasks.
    """
    reader = spark.read.schema(text_schema(columns)).option("header", True).option("escape", '"')
    reader = reader.option("nullValue", _NULL_MARK).option("emptyValue", "").option("multiLine", multi_line)
    return reader.option("recursiveFileLookup", recursive).csv(paths)


def read_feed_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Header-less comma separated log files."""
    return spark.read.schema(text_schema(columns)).option("header", False).option("sep", ",").csv(path)
