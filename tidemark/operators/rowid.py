"""Dense row numbers without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

ROWS_PER_RANGE = 1_000_000
FEW_FILES = 100_000  # offsets of so many files, about 10 MB, are broadcast; those of more are joined by a shuffle


def with_dense_row_id(
    df: DataFrame, name: str = "sparkuniqueid", order_by: list[str | Column] | None = None, partitions: int | None = None,
    rows_per_range: int = ROWS_PER_RANGE, few_files: int = FEW_FILES,
) -> DataFrame:
    """Number the rows 1..N, following ``order_by`` when given; rows that are equal in it keep the order they arrive in.

    Rows keep the partitions they arrive in, or are range-partitioned and sorted locally, in as many ranges as their
    number asks for. The place of arrival ends the order, so rows with one value spread over several ranges. The rows are
    written once, which fixes their places; a row's number is its position in its file plus the rows of the files before
    it, which the files' footers tell. An empty frame gives no rows.
    """
    placed = df
    if order_by:
        ranges = partitions or max(1, -(-df.count() // rows_per_range))
        order = [*order_by, "__tm_arrival"]
        arrived = df.withColumn("__tm_arrival", F.monotonically_increasing_id())
        placed = arrived.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(*(f"`{c}`" for c in df.columns))
    placed = materialize(placed, "rowid")
    place = placed.metadataColumn("_metadata")

    counts = placed.groupBy(place["file_name"].alias("__tm_file")).agg(F.count("*").alias("__tm_rows"))
    # Tasks number their files part-<task>-<run>-c<file of the task>; the numbers can have more digits than usual.
    numbers = [F.regexp_extract("__tm_file", pattern, 1).cast("bigint") for pattern in (r"^part-(\d+)-", r"-c(\d+)\.")]
    before = Window.orderBy(*numbers).rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    offsets = counts.select("__tm_file", F.coalesce(F.sum("__tm_rows").over(before), F.lit(0)).alias("__tm_offset"))
    offsets = materialize(offsets, "rowid-offsets")
    if offsets.count() <= few_files:
        offsets = F.broadcast(offsets)

    own = placed.select("*", place["file_name"].alias("__tm_file"), place["row_index"].alias("__tm_index"))
    number = (F.col("__tm_offset") + F.col("__tm_index") + 1).cast("bigint").alias(name)
    return own.join(offsets, "__tm_file").select(*(f"`{c}`" for c in df.columns), number)
