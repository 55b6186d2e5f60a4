"""The nightly jobs over chosen datasets: publish, full export, promotion.

Datasets come as descriptor rows: iddataset, datasetversion, datasetcode, family, campi, dbhiveschema, dbhivetable, and
per job solrcollectionname, folder or the source table. Datasets sharing a target or a column list are handled in one
plan; Python only loops over what Spark must treat as different tables.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.export import document_counts, full_export
from tidemark.plans.incremental import run_incremental_export
from tidemark.plans.promote import promote
from tidemark.plans.publish import publish, serving_documents
from tidemark.plans.state import STATE_KEYS, merge_state, stop_incremental
from tidemark.sinks.stats import append_stats, stats_rows
from tidemark.sinks.tables import StateTable
from tidemark.sources.snapshots import PARTITIONS, snapshot
from tidemark.sources.tables import lake_table, scan_dataset

TABLES_PER_PLAN = 50


def table_name(descriptor: Row) -> str:
    return f"{descriptor['dbhiveschema']}.{descriptor['dbhivetable']}"


def fields_of(descriptor: Row) -> list[tuple[str, str]]:
    return [(field["fieldName"], field["dataType"]) for field in descriptor["campi"]]


def lake_documents(spark: SparkSession, descriptor: Row) -> DataFrame:
    """All rows of a dataset's lake table as documents."""
    lake = lake_table(spark, descriptor["dbhiveschema"], descriptor["dbhivetable"])
    ids = (descriptor["iddataset"], descriptor["datasetversion"], descriptor["family"])
    return scan_dataset(lake, fields_of(descriptor), *ids, with_row_number=False)


def _groups(chosen: DataFrame, key: Callable[[Row], object], tables: int) -> Iterator[list[Row]]:
    """Descriptor rows in batches of one key; a batch is one plan of at most ``tables`` tables.

    All versions of a dataset are in one batch, however many, because replacing a dataset clears all of them.
    """
    found: dict[object, dict[int, list[Row]]] = {}
    for row in chosen.toLocalIterator():
        found.setdefault(key(row), {}).setdefault(row["iddataset"], []).append(row)
    for datasets in found.values():
        batch: list[Row] = []
        for versions in datasets.values():
            if batch and len(batch) + len(versions) > tables:
                yield batch
                batch = []
            batch += versions
        yield batch


def _together(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def publish_datasets(
    spark: SparkSession, chosen: DataFrame, collection_path: Callable[[str], str], mode: str = "overwrite",
    forced_collection: str = "none", dt_as: str = "date", state: StateTable | None = None,
    stats_path: str | None = None, project: str = "", coordinator: str = "", ids_may_move: bool = True,
    tables_per_plan: int = TABLES_PER_PLAN,
) -> list[DataFrame]:
    """Publish the chosen datasets, one pass per collection, and reconcile every one of them, empty ones too.

    The descriptors say what is replaced, so the result does not depend on how they fall into plans. With ``state``
    their incremental export is switched off. Returns the reconciliation reports.
    """
    own = forced_collection.lower() == "none"
    reports = []
    for batch in _groups(chosen, lambda row: row["solrcollectionname"] if own else forced_collection, tables_per_plan):
        collection = batch[0]["solrcollectionname"] if own else forced_collection
        started = time.monotonic()
        docs = _together([serving_documents(lake_documents(spark, row), dt_as) for row in batch])
        keys = _described(spark, batch).withColumnsRenamed(dict(zip(STATE_KEYS, PARTITIONS)))
        report = publish(spark, collection_path(collection), docs, mode, ids_may_move, keys)
        reports.append(report)
        described = _described(spark, batch).join(report.withColumnsRenamed(dict(zip(PARTITIONS, STATE_KEYS))), STATE_KEYS)
        if state is not None and mode.lower() != "nowrite":
            state.update(lambda now: merge_state(now, stop_incremental(described)))
        if stats_path:
            counts = described.withColumn("destination", F.lit(collection))
            elapsed = int(1000 * (time.monotonic() - started))
            append_stats(stats_rows(counts, "publish", project, coordinator, elapsed), stats_path)
    return reports


def export_datasets(
    spark: SparkSession, chosen: DataFrame, state: StateTable, mode: str, run_id: str, time_zone: str = "UTC",
    stats_path: str | None = None, project: str = "", coordinator: str = "", tables_per_plan: int = TABLES_PER_PLAN,
) -> list[str]:
    """Full CSV export of the chosen datasets; those with the same columns are written together."""
    published = []
    for batch in _groups(chosen, lambda row: (row["family"], tuple(fields_of(row))), tables_per_plan):
        started = time.monotonic()
        docs = _together([lake_documents(spark, row) for row in batch])
        described = _described(spark, batch)
        sizes = document_counts(docs)
        published += full_export(spark, docs, described, state, mode, run_id, time_zone, sizes=sizes)
        if stats_path:
            counts = described.join(sizes.withColumnRenamed("documents", "record_read"), STATE_KEYS, "left")
            counts = counts.fillna(0, ["record_read"]).select("*", F.col("folder").alias("destination"), F.col("record_read").alias("record_write"))
            elapsed = int(1000 * (time.monotonic() - started))
            append_stats(stats_rows(counts, "export", project, coordinator, elapsed), stats_path)
    return published


def incremental_datasets(
    spark: SparkSession, chosen: DataFrame, collection_path: Callable[[str], str], state: StateTable, upper_id: str,
    time_zone: str = "UTC",
) -> list[str]:
    """Export the new documents of the chosen datasets, collection by collection, each with its own field list."""
    published = []
    for row in chosen.select("solrcollectionname").distinct().toLocalIterator():
        own = chosen.where(F.col("solrcollectionname").eqNullSafe(row[0]))
        published += run_incremental_export(spark, snapshot(spark, collection_path(row[0])), own, state, upper_id, time_zone)
    return published


def promote_datasets(
    spark: SparkSession, chosen: DataFrame, load_time: str, stats_path: str | None = None, project: str = "",
    coordinator: str = "", **options,
) -> dict[str, int]:
    """Promote the chosen datasets from their source tables (jdbcdbhive, jdbctablename); rows per lake table."""
    promoted = {}
    for row in chosen.toLocalIterator():
        started = time.monotonic()
        source = f"{row['jdbcdbhive']}.{row['jdbctablename']}"
        columns = [name.lower() for name, _ in fields_of(row)]
        rows = promote(
            spark.table(source), columns, table_name(row), load_time, id_space=row["iddataset"], **options
        )
        promoted[table_name(row)] = rows
        if stats_path:
            one = spark.createDataFrame(
                [(source, table_name(row), rows, rows, row["datasetcode"])],
                "source string, destination string, record_read bigint, record_write bigint, dataset_code string",
            )
            elapsed = int(1000 * (time.monotonic() - started))
            append_stats(stats_rows(one, "promote", project, coordinator, elapsed), stats_path)
    return promoted


def _described(spark: SparkSession, batch: list[Row]) -> DataFrame:
    """The batch's descriptors as a frame, with the lake table as the source."""
    rows = [
        (r["iddataset"], r["datasetversion"], r["datasetcode"], r["folder"] if "folder" in r else None, table_name(r))
        for r in batch
    ]
    schema = "iddataset bigint, datasetversion bigint, dataset_code string, folder string, source string"
    return spark.createDataFrame(rows, schema).withColumn("datasetcode", F.col("dataset_code"))
