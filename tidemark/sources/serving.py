"""Serving collections: document tables stored by dataset and version, read by snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.snapshots import COMMIT, PARTITIONS, read_snapshot, snapshot


def collection_schema(spark: SparkSession, path: str) -> T.StructType:
    """Columns of a collection: datasets fill different ones, so no single file shows them all."""
    return snapshot(spark, path).schema


def read_collection(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The documents of the newest snapshot, or of an older one that is still kept."""
    return read_snapshot(spark, snapshot(spark, path, number))


def stream_collection(spark: SparkSession, path: str) -> DataFrame:
    """Documents as a stream of the files that commits write; a rewritten partition's documents arrive again."""
    of = snapshot(spark, path)
    typed = T.StructType([*of.schema.fields, T.StructField(COMMIT, T.StringType())])
    return spark.readStream.schema(typed).parquet(of.data).select(*of.schema.names)


# datasets named one by one in a scan's filter; beyond that the range of their numbers is used
NAMED_DATASETS = 1000


def in_partitions(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """Documents of the datasets and versions of ``keys`` (or of the datasets, if it has no versions).

    The numbers of the datasets, few whatever the number of documents, go into the scan's partition filter, so that
    other folders are not read.
    """
    own = [name for name in PARTITIONS if name in keys.columns]
    keys = keys.select(*own).distinct()
    numbers = keys.select(PARTITIONS[0]).distinct()
    first, last, count = numbers.agg(F.min(PARTITIONS[0]), F.max(PARTITIONS[0]), F.count("*")).first()
    if not count:
        return docs.where(F.lit(False))
    chosen = F.col(PARTITIONS[0]).between(first, last)
    if count <= NAMED_DATASETS:
        chosen = F.col(PARTITIONS[0]).isin([row[0] for row in numbers.collect()])
    return docs.where(chosen).join(keys, own, "left_semi")


def of_dataset(docs: DataFrame, dataset_id: int, version: int | None = None) -> DataFrame:
    """Documents of one dataset; a missing or non-positive version means all of them. Prunes partitions."""
    chosen = F.col("iddataset_l") == dataset_id
    if version is not None and version > 0:
        chosen &= F.col("datasetversion_l") == version
    return docs.where(chosen)


def id_range(docs: DataFrame, after: str | None, up_to: str | None) -> DataFrame:
    """Documents with ``after < id <= up_to``; a missing bound is open."""
    if after is not None:
        docs = docs.where(F.col("id") > after)
    if up_to is not None:
        docs = docs.where(F.col("id") <= up_to)
    return docs


def serving_scan(
    spark: SparkSession, path: str, dataset_id: int, version: int, fields: Sequence[str] | None = None
) -> DataFrame:
    docs = of_dataset(read_collection(spark, path), dataset_id, version)
    return docs.select(*fields) if fields else docs


def serving_count(
    docs: DataFrame, dataset_id: int, version: int | None = None, after: str | None = None, up_to: str | None = None
) -> int:
    return id_range(of_dataset(docs, dataset_id, version), after, up_to).count()


def count_by_version(docs: DataFrame) -> DataFrame:
    """Document counts of every dataset and version at once."""
    return docs.groupBy(*PARTITIONS).agg(F.count("*").alias("documents"))


def count_and_max(docs: DataFrame) -> DataFrame:
    """Count and highest id per dataset and version in one pass."""
    return docs.groupBy(*PARTITIONS).agg(F.count("*").alias("documents"), F.max("id").alias("max_id"))
