"""Keyed writes to a serving collection stored by dataset and version, each one commit."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.latest import newest_per_key
from tidemark.operators.merge import delete_where
from tidemark.session import materialize
from tidemark.sources.serving import in_partitions
from tidemark.sources.snapshots import PARTITIONS, CommitConflict, Snapshot, commit, read_snapshot, snapshot

T_ = TypeVar("T_")
TRIES = 10  # of a write that other writers overtake
WRITE_MODES = ("nowrite", "append", "overwrite")


def check_mode(mode: str) -> str:
    mode = mode.lower()
    if mode not in WRITE_MODES:
        raise ValueError(f"invalid write mode {mode!r}, valid values are {', '.join(WRITE_MODES)}")
    return mode


def to_documents(df: DataFrame) -> DataFrame:
    """Rows as stored: decimals become doubles, the store's own version field is left out, a missing id is made up."""
    columns = []
    for field in df.schema:
        if field.name == "_version":
            continue
        column = F.col(f"`{field.name}`")
        columns.append(column.cast("double").alias(field.name) if isinstance(field.dataType, T.DecimalType) else column)
    docs = df.select(*columns)
    if "id" not in docs.columns:
        return docs.withColumn("id", F.expr("uuid()"))
    if not df.schema["id"].nullable:
        return docs
    return docs.withColumn("id", F.coalesce("id", F.expr("uuid()")))


def write_partitions(docs: DataFrame, path: str) -> None:
    """Replace the partitions present in the frame, in one commit."""
    spark = docs.sparkSession
    _again(lambda: commit(spark, snapshot(spark, path), docs))


def _again(write: Callable[[], T_], tries: int = TRIES) -> T_:
    """Begin a write again, from the newest snapshot, where another writer has committed first."""
    for turn in range(tries):
        try:
            return write()
        except CommitConflict:
            if turn == tries - 1:
                raise
    raise AssertionError("tries must be positive")


def _distinct_documents(docs: DataFrame, newest_first: list | None) -> DataFrame:
    docs = to_documents(docs)
    return newest_per_key(docs, ["id"], newest_first) if newest_first else docs.dropDuplicates(["id"])


def merge_documents(
    spark: SparkSession, path: str, source: DataFrame, newest_first: list | None = None,
    replace_origin: str | None = None, ids_may_move: bool = True, replaced: DataFrame | None = None,
) -> DataFrame:
    """Upsert by ``id`` over the whole collection, rewriting only the partitions that change, in one commit.

    These are the partitions of the new documents, those holding an older document with one of their ids (found
    by a scan of the id and partition columns) and, with ``replace_origin``, those holding documents of that
    origin of the same datasets (or of ``replaced``), which are deleted in all versions. The new rows are written down first: made-up
    ids and the choice among repeated ids must not change between the passes. Returns the new documents.

    ``ids_may_move=False`` promises that an id never changes its dataset or version and saves the scan for them.
    """
    incoming = materialize(_distinct_documents(source, newest_first), "incoming")
    if incoming.where(F.col(PARTITIONS[0]).isNull() | F.col(PARTITIONS[1]).isNull()).take(1):
        raise ValueError("documents without a dataset or version cannot be stored")
    datasets = None
    if replace_origin is not None:
        datasets = materialize(incoming.select("iddataset_l").distinct() if replaced is None else replaced, "replaced")
    return _again(lambda: _merge(spark, snapshot(spark, path), incoming, replace_origin, datasets, ids_may_move))


def _merge(spark: SparkSession, base: Snapshot, incoming: DataFrame, replace_origin: str | None, datasets: DataFrame | None, ids_may_move: bool) -> DataFrame:
    if not base.number:
        commit(spark, base, incoming)
        return incoming
    stored = read_snapshot(spark, base)
    types = {f.name: f.dataType for f in stored.schema}
    incoming = incoming.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in incoming.columns])

    touched = incoming.select(*PARTITIONS)
    if ids_may_move:
        low, high = incoming.agg(F.min("id"), F.max("id")).first()
        reach = stored.select("id", *PARTITIONS).where(F.col("id").between(low, high))
        placed = reach.join(incoming.select("id"), "id", "left_semi")
        touched = touched.unionByName(placed.select(*PARTITIONS))
    if replace_origin is not None:
        outdated = stored.where(F.col("origin_s") == replace_origin).join(datasets, "iddataset_l", "left_semi")
        touched = touched.unionByName(outdated.select(*PARTITIONS))
    touched = materialize(touched.distinct(), "touched")

    kept = in_partitions(stored, touched).join(incoming.select("id"), "id", "left_anti")
    if replace_origin is not None:
        flagged = kept.join(datasets.withColumn("_replaced", F.lit(True)), "iddataset_l", "left")
        stale = F.col("_replaced") & (F.col("origin_s") == replace_origin)
        kept = delete_where(flagged, stale).drop("_replaced").select(*stored.columns)
    commit(spark, base, kept.unionByName(incoming, allowMissingColumns=True), touched)
    return incoming


def delete_documents(spark: SparkSession, path: str, dataset_id: int, version: int | None = None, origin: str = "datalake") -> None:
    """Delete a dataset's documents of one origin, by default in all its versions."""
    chosen = (F.col("iddataset_l") == dataset_id) & (F.col("origin_s") == origin)
    of_dataset = F.col("iddataset_l") == dataset_id
    if version is not None and version > 0:
        chosen &= F.col("datasetversion_l") == version
        of_dataset &= F.col("datasetversion_l") == version
    delete_matching(spark, path, chosen, of_dataset)


def delete_matching(spark: SparkSession, path: str, predicate: Column, partition_filter: Column | None = None) -> None:
    """Delete by predicate, rewriting only the partitions with matching rows."""
    _again(lambda: _delete(spark, snapshot(spark, path), predicate, partition_filter))


def _delete(spark: SparkSession, base: Snapshot, predicate: Column, partition_filter: Column | None) -> None:
    stored = read_snapshot(spark, base)
    reach = stored.where(partition_filter) if partition_filter is not None else stored
    touched = materialize(reach.where(predicate).select(*PARTITIONS).distinct(), "touched")
    if not touched.isEmpty():
        commit(spark, base, delete_where(in_partitions(reach, touched), predicate), touched)
