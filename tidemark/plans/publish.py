"""Publishing lake datasets to a serving collection, with count reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fieldtypes import cast_by_suffix
from tidemark.session import materialize
from tidemark.sinks.serving import check_mode, merge_documents, to_documents
from tidemark.sources.serving import count_by_version, in_partitions, read_collection
from tidemark.sources.snapshots import PARTITIONS, documents_by_version, snapshot

LAKE_ORIGIN = "datalake"


class PublishMismatch(RuntimeError):
    """The collection does not hold what was published."""


def serving_documents(lake_rows: DataFrame, dt_as: str = "date") -> DataFrame:
    """Scanned lake rows typed for the serving store, without the lake's row number."""
    return cast_by_suffix(lake_rows, dt_as).drop("sparkuniqueid")


def row_blocks(rows: DataFrame, size: int, start: int = 0, row_number: str = "sparkuniqueid") -> DataFrame:
    """Row counts per half-open block of row numbers [start + k*size, start + (k+1)*size)."""
    block = F.floor((F.col(row_number) - start) / size).cast("bigint")
    return rows.where(F.col(row_number) >= start).groupBy(block.alias("block")).agg(F.count("*").alias("rows"))


def publish(
    spark: SparkSession, path: str, docs: DataFrame, mode: str = "overwrite", ids_may_move: bool = True,
    described: DataFrame | None = None,
) -> DataFrame:
    """Write documents of any number of datasets in one pass and reconcile the counts.

    ``overwrite`` first deletes what the lake published earlier for the same datasets, ``append`` only replaces
    documents with equal ids, ``nowrite`` counts without touching the collection. Returns one row per dataset
    version: record_read, record_before, record_after, record_write.

    ``described`` (iddataset_l, datasetversion_l) names the dataset versions that are published, with or without
    documents: an empty one is cleared and reported with zeros. Without it they are those of the documents.
    """
    mode = check_mode(mode)
    read = count_by_version(to_documents(docs)).withColumnRenamed("documents", "record_read")
    datasets = None
    if described is not None:
        described = described.select(*PARTITIONS).distinct()
        read = described.join(read, PARTITIONS, "left").fillna(0, ["record_read"])
        datasets = described.select("iddataset_l").distinct()
    if mode == "nowrite":
        return _report(read, _counts(spark, path), _counts(spark, path), None)
    before = _counts(spark, path)
    read, before = _hold(read), _hold(before)
    replaced = LAKE_ORIGIN if mode == "overwrite" else None
    incoming = merge_documents(spark, path, docs, replace_origin=replaced, ids_may_move=ids_may_move, replaced=datasets)
    stored = read_collection(spark, path)
    arrived = in_partitions(stored, incoming).join(incoming.select("id", *PARTITIONS), ["id", *PARTITIONS], "left_semi")
    report = _hold(_report(read, before, _counts(spark, path), count_by_version(arrived)))
    differing = report.where(F.col("record_read") != F.col("record_write")).take(5)
    if differing:
        raise PublishMismatch(f"documents read and written differ: {differing}")
    return report


def _counts(spark: SparkSession, path: str) -> DataFrame:
    """Documents of each dataset version, as the manifest of the newest snapshot has them."""
    return documents_by_version(spark, snapshot(spark, path))


def _hold(counts: DataFrame) -> DataFrame:
    """Fix counts taken before the collection changes."""
    return materialize(counts, "counts")


def _report(read: DataFrame, before: DataFrame, after: DataFrame, written: DataFrame | None) -> DataFrame:
    report = read.join(before.withColumnRenamed("documents", "record_before"), PARTITIONS, "left")
    report = report.join(after.withColumnRenamed("documents", "record_after"), PARTITIONS, "left")
    if written is None:
        report = report.withColumn("record_write", F.lit(0).cast("bigint"))
    else:
        report = report.join(written.withColumnRenamed("documents", "record_write"), PARTITIONS, "left")
    return report.fillna(0, ["record_before", "record_after", "record_write"])
