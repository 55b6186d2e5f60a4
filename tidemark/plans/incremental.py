"""Incremental CSV export: every dataset's new documents in one plan."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fieldtypes import csv_header, csv_text_columns, document_fields
from tidemark.functions.objectid import NEVER_ID
from tidemark.plans.state import STATE_KEYS, advance_state, last_ids
from tidemark.session import materialize, scratch_path
from tidemark.sinks.csv_out import RESERVED, ROWS_PER_FILE, TURN, publish_files, refuse_reserved, write_in_files
from tidemark.sinks.tables import StateTable
from tidemark.sources.serving import NAMED_DATASETS, count_and_max, in_partitions
from tidemark.sources.snapshots import PARTITIONS, Snapshot, read_id_ranges

DROPPED = ("id", "iddataset_l", "datasetversion_l", "origin_s", "sparkuniqueid")


class ExportMismatch(RuntimeError):
    """The files written do not hold the rows that were counted."""


def as_document_keys(df: DataFrame) -> DataFrame:
    """State or descriptor keys under their serving names."""
    return df.withColumnsRenamed(dict(zip(STATE_KEYS, PARTITIONS)))


def pending_documents(docs: DataFrame, datasets: DataFrame, state: DataFrame, upper_id: str | Column) -> DataFrame:
    """Documents of the datasets in the range (last exported id, upper id].

    Switched-off datasets are left out first. The active ones' numbers and their least last id, a few values whatever
    the number of documents, go into the scan's filters, so that other partitions and older row groups are skipped.
    """
    upper = F.lit(upper_id) if isinstance(upper_id, str) else upper_id
    targets = _active(datasets, state)
    some = targets.limit(NAMED_DATASETS + 1).collect()
    if not some:
        return docs.where(F.lit(False))
    if len(some) <= NAMED_DATASETS:
        least = min(row["last_id"] for row in some)
        reach = docs.where(F.col(PARTITIONS[0]).isin(sorted({row[PARTITIONS[0]] for row in some})))
        targets = docs.sparkSession.createDataFrame(some, targets.schema)
    else:
        least = targets.agg(F.min("last_id")).first()[0]
        reach = in_partitions(docs, targets)
    reach = reach.where((F.col("id") <= upper) & (F.col("id") > least))
    return reach.join(targets, PARTITIONS, "inner").where(F.col("id") > F.col("last_id")).select(*docs.columns)


def pending_in_snapshot(spark: SparkSession, of: Snapshot, datasets: DataFrame, state: DataFrame, upper_id: str) -> DataFrame:
    """The same documents of a collection's snapshot, from the files that its manifest names for each dataset's own range.

    A dataset that starts anew doesn't make the others' history be read: the range of a file's ids is compared with the
    range of its own dataset.
    """
    targets = _active(datasets, state)
    found = read_id_ranges(spark, of, targets.select(*PARTITIONS, F.col("last_id").alias("after"), F.lit(upper_id).alias("up_to")))
    kept = found.join(targets, PARTITIONS).where((F.col("id") > F.col("last_id")) & (F.col("id") <= upper_id))
    return kept.select(*found.columns)


def _active(datasets: DataFrame, state: DataFrame) -> DataFrame:
    """Datasets whose incremental export isn't switched off, under their serving names, with their last exported id."""
    return as_document_keys(last_ids(datasets.select(*STATE_KEYS).distinct(), state).where(F.col("last_id") != NEVER_ID))


def own_columns(docs: DataFrame, fields: list[tuple[str, str]], family: str) -> DataFrame:
    """Documents with the columns of their dataset's field list only; a field no document has yet is null."""
    present = set(docs.columns)
    typed = document_fields(fields, family)
    return docs.select("id", *PARTITIONS, *[F.col(f"`{n}`") if n in present else F.lit(None).cast(t).alias(n) for n, t in typed])


def next_state(pending: DataFrame) -> DataFrame:
    """Per dataset with pending documents: how many, and the id to remember."""
    found = count_and_max(pending).withColumnsRenamed(dict(zip(PARTITIONS, STATE_KEYS)))
    return found.withColumnRenamed("max_id", "last_id")


def csv_rows(docs: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """Documents as CSV rows: text rules applied, technical columns dropped, header names without suffixes."""
    text = csv_text_columns(docs.drop(*DROPPED), time_zone)
    return text.toDF(*csv_header(text.columns))


def write_dataset_files(
    docs: DataFrame, sizes: DataFrame, descriptors: DataFrame, oid: Column, time_zone: str = "UTC",
    rows_per_file: int = ROWS_PER_FILE,
) -> list[str]:
    """Write documents as CSV files of their datasets and publish them under the final names.

    ``sizes`` has the document count per dataset version, ``descriptors`` its folder and code. The writing job counts
    the rows of its files, and both counts are compared before any file becomes visible.
    """
    spark = docs.sparkSession
    stage = scratch_path(spark, "export")
    body = csv_rows(docs, time_zone).columns
    refuse_reserved(body)
    keyed = docs.select(*docs.columns, *[F.col(k).alias(RESERVED + name) for k, name in zip(PARTITIONS, STATE_KEYS)], F.xxhash64("id").alias(TURN))
    text = csv_text_columns(keyed.drop(*DROPPED), time_zone)
    rows = text.toDF(*body, *[RESERVED + name for name in STATE_KEYS], TURN)
    counts = sizes.select(*STATE_KEYS, F.col("documents").alias("rows"))
    files = materialize(write_in_files(rows, counts, STATE_KEYS, stage, rows_per_file), "files")
    per_dataset = files.groupBy(*STATE_KEYS).agg(F.sum("rows").alias("written"))
    differing = counts.join(per_dataset, STATE_KEYS, "left").where(~F.col("rows").eqNullSafe(F.col("written")))
    wrong = differing.take(5)
    if wrong:
        raise ExportMismatch(f"rows counted and written differ: {wrong}")
    named = files.join(descriptors.select(*STATE_KEYS, "folder", "datasetcode"), STATE_KEYS)
    return publish_files(named, F.col("folder"), oid, F.col("datasetcode"), F.col("datasetversion"))


def run_incremental_export(
    spark: SparkSession, docs: DataFrame | Snapshot, descriptors: DataFrame, state: StateTable, upper_id: str,
    time_zone: str = "UTC", rows_per_file: int = ROWS_PER_FILE,
) -> list[str]:
    """Export what is new since the last run and remember how far it went.

    Of a snapshot of a collection only the files are read that may hold new documents of their dataset.

    Descriptors with ``campi`` and ``family`` are exported in groups of one field list, each with its own columns;
    without them the collection's columns are those of every dataset. Files come first and the state last: a run that
    breaks in between is repeated from the old state, and with the same upper id it writes the same file names.
    """
    before, published, found = state.read(), [], []
    for fields, family, group in layouts(descriptors):
        pending = pending_in_snapshot(spark, docs, group, before, upper_id) if isinstance(docs, Snapshot) else pending_documents(docs, group, before, upper_id)
        pending = pending if fields is None else own_columns(pending, fields, family)
        sizes = materialize(next_state(pending), "sizes")
        published += write_dataset_files(pending, sizes, group, F.lit(upper_id), time_zone, rows_per_file)
        found.append(sizes)
    if found:
        state.update(lambda now: advance_state(now, reduce(DataFrame.unionByName, found)))
    return published


def layouts(descriptors: DataFrame) -> Iterator[tuple[list[tuple[str, str]] | None, str | None, DataFrame]]:
    """The distinct field lists among the datasets, each with its family and the descriptors that share it."""
    if "campi" not in descriptors.columns:
        yield None, None, descriptors
        return
    marked = descriptors.withColumn("_layout", F.xxhash64(F.to_json(F.struct("campi", "family"))))
    for row in marked.groupBy("_layout").agg(F.first("campi").alias("campi"), F.first("family").alias("family")).toLocalIterator():
        fields = [(field["fieldName"], field["dataType"]) for field in row["campi"] or []]
        yield fields, row["family"], marked.where(F.col("_layout") == row["_layout"]).drop("_layout")
