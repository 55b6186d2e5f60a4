"""Full CSV export of lake tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.functions.paths import FILE_NAME
from tidemark.plans.incremental import write_dataset_files
from tidemark.plans.state import STATE_KEYS, merge_state, stop_incremental
from tidemark.session import materialize
from tidemark.sinks.csv_out import ROWS_PER_FILE
from tidemark.sinks.serving import check_mode
from tidemark.sinks.tables import StateTable
from tidemark.sources.serving import PARTITIONS


def full_export(
    spark: SparkSession, docs: DataFrame, descriptors: DataFrame, state: StateTable, mode: str, run_id: str,
    time_zone: str = "UTC", rows_per_file: int = ROWS_PER_FILE, sizes: DataFrame | None = None,
) -> list[str]:
    """Export whole datasets, given as documents, and switch their incremental export off.

    ``overwrite`` removes the earlier files of the described dataset versions once the new ones are in place, also of
    those that have no documents any more; files of other datasets or versions in the same folder stay. ``append``
    keeps them all, ``nowrite`` has no effect at all. ``sizes``: the document counts, where the caller has them already.
    """
    mode = check_mode(mode)
    if mode == "nowrite":
        return []
    sizes = document_counts(docs) if sizes is None else sizes
    published = write_dataset_files(docs, sizes, descriptors, F.lit(run_id), time_zone, rows_per_file)
    if mode == "overwrite":
        _remove_older_files(spark, descriptors, published)
    state.update(lambda now: merge_state(now, stop_incremental(descriptors)))
    return published


def document_counts(docs: DataFrame) -> DataFrame:
    """Documents of each dataset version, counted once and kept."""
    counted = docs.groupBy(*PARTITIONS).agg(F.count("*").alias("documents"))
    return materialize(counted.withColumnsRenamed(dict(zip(PARTITIONS, STATE_KEYS))), "sizes")


def _remove_older_files(spark: SparkSession, descriptors: DataFrame, published: list[str]) -> None:
    """Delete the files in the datasets' folders that carry a described code and version and are not new (names only)."""
    disk, keep = Files(spark), set(published)
    codes = F.collect_set(F.struct("datasetcode", F.col("datasetversion").cast("string").alias("version"))).alias("codes")
    for row in descriptors.groupBy("folder").agg(codes).toLocalIterator():
        own = {(code["datasetcode"], code["version"]) for code in row["codes"]}
        for name in disk.names(row["folder"]):
            parts = re.match(FILE_NAME, name)
            if parts and parts.group(3, 4) in own and f"{row['folder']}/{name}" not in keep:
                disk.delete(f"{row['folder']}/{name}")
