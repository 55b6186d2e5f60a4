"""JDBC scans, read in parallel ranges instead of through one connection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str, table: str, driver: str | None = None, user: str | None = None, password: str | None = None,
    split_column: str | None = None, lower: int | None = None, upper: int | None = None, splits: int | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Reader options; the four split arguments belong together and only steer parallelism, never filter."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    options.update({k: v for k, v in (("driver", driver), ("user", user), ("password", password)) if v is not None})
    given = [x is not None for x in (split_column, lower, upper, splits)]
    if any(given) and not all(given):
        raise ValueError("split_column, lower, upper and splits must be given together")
    if all(given):
        options.update(
            partitionColumn=split_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(splits)
        )
    return options


def jdbc_scan(spark: SparkSession, query: str, **connection) -> DataFrame:
    """Scan of a table name or of a sub-query text; filters and columns are pushed to the database by Spark."""
    table = f"({query.strip()}) q" if query.strip().lower().startswith("select") else query
    return spark.read.format("jdbc").options(**jdbc_options(table=table, **connection)).load()
