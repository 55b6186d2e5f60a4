"""Streaming log ingestion: each run takes the new files of a feed and files them by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.plans.logs import DAY, LAYOUTS, with_day
from tidemark.sources.csv_files import text_schema


def log_stream(spark: SparkSession, path: str, layout: str, archive: str | None = None, max_files: int | None = None) -> DataFrame:
    """New log files as a stream; with ``archive`` the consumed files are moved there once they are committed."""
    reader = spark.readStream.schema(text_schema(LAYOUTS[layout])).option("header", False).option("sep", ",")
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return with_day(reader.csv(path))


def start_log_ingest(logs: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Take everything available, then stop. The file sink's own log makes each file count once."""
    writer = logs.writeStream.format("orc").outputMode("append").partitionBy(*DAY)
    return writer.option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
