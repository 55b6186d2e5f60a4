"""Statistics log: one row per processed dataset, one schema for every job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATS_COLUMNS = (
    "timeoperation timestamp, id_application string, spark_app_name string, prjname string, job string, "
    "source string, destination string, record_read bigint, record_write bigint, elapsed_ms bigint, "
    "dataset_code string, coordinator_name string"
)


def stats_rows(
    counts: DataFrame, job: str, project: str = "", coordinator: str = "", elapsed_ms: int = 0
) -> DataFrame:
    """Log rows from per-dataset counts (source, destination, record_read, record_write, dataset_code)."""
    context = counts.sparkSession.sparkContext
    return counts.select(
        F.current_timestamp().alias("timeoperation"),
        F.lit(context.applicationId).alias("id_application"),
        F.lit(context.appName).alias("spark_app_name"),
        F.lit(project).alias("prjname"),
        F.lit(job).alias("job"),
        "source",
        "destination",
        F.col("record_read").cast("bigint").alias("record_read"),
        F.col("record_write").cast("bigint").alias("record_write"),
        F.lit(elapsed_ms).cast("bigint").alias("elapsed_ms"),
        "dataset_code",
        F.lit(coordinator).alias("coordinator_name"),
    )


def append_stats(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").orc(path)
