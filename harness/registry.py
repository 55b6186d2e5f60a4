"""Registry of the driver-facing queries and their oracle texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from harness.views import Inputs, oracle_text
from tidemark.session import apply_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query over the inputs; ``oracle`` may refer to tables and views as ``{name}``."""

    def wrap(build: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Inputs(apply_settings(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle_text(oracle)
        return build

    return wrap


def plain_types(df: DataFrame) -> DataFrame:
    """Times as text and floats as doubles, which both engines print alike."""

    def plain(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            return column.cast("string").alias(field.name)
        if isinstance(field.dataType, T.FloatType):
            return column.cast("double").alias(field.name)
        return column

    return df.select(*[plain(f) for f in df.schema])
