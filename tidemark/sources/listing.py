"""File listings as frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.paths import parse_file_name
from tidemark.functions.text import below, listing_bytes, listing_path, stage_tenant


def file_sizes(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """(byte, path) of every file below a folder; file contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(F.col("length").alias("byte"), F.col("_metadata.file_path").alias("path"))


def folder_sizes(files: DataFrame, root: str) -> DataFrame:
    """Files and bytes per folder right below the root."""
    inside = F.element_at(F.split("path", F.lit(root.rstrip("/") + "/"), 2), -1)
    return files.groupBy(F.substring_index(inside, "/", 1).alias("folder")).agg(
        F.count("*").alias("files"), F.sum("byte").alias("byte")
    )


def parse_collection_listing(lines: DataFrame, root: str, line: str = "line") -> DataFrame:
    """``bytes <blanks> path`` lines of the serving area to (byte, collectionname)."""
    return lines.select(
        listing_bytes(F.col(line)).alias("byte"), below(listing_path(F.col(line)), root).alias("collectionname")
    )


def parse_stage_listing(lines: DataFrame, line: str = "line") -> DataFrame:
    """``bytes <blanks> path`` lines of the stage area to (byte, stg_path, tenantcode), all text."""
    path = listing_path(F.col(line))
    return lines.select(
        listing_bytes(F.col(line)).alias("byte"), path.alias("stg_path"), stage_tenant(path).alias("tenantcode")
    )


def name_parts(files: DataFrame) -> DataFrame:
    """Add the folder, the file name and the parts of the name to rows with a ``path``."""
    named = files.withColumn("file_name", F.element_at(F.split("path", "/"), -1))
    parts = [column.alias(name) for name, column in parse_file_name(F.col("file_name")).items()]
    return named.select("*", F.regexp_replace("path", "/[^/]+$", "").alias("folder"), *parts)


def raw_csv_files(spark: SparkSession, root: str) -> DataFrame:
    """Raw CSV files that follow the naming rule: path, size, folder, name parts."""
    return name_parts(file_sizes(spark, root, "*.csv")).where(F.col("oid").isNotNull())
