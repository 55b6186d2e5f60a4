"""Snapshots of a serving collection: which files it consists of, commit by commit."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import Files

PARTITIONS = ["iddataset_l", "datasetversion_l"]
COMMIT = "tm_commit"  # partition column above the documents' own ones: the commit that wrote a file
KEPT = 5  # snapshots that stay readable

# The manifest has a row a file: its partition, its documents and the range of their ids.
MANIFEST = f"{COMMIT} string, iddataset_l bigint, datasetversion_l bigint, file string, documents bigint, min_id string, max_id string"


class CommitConflict(RuntimeError):
    """Another writer has committed to the collection meanwhile."""


@dataclass(frozen=True)
class Snapshot:
    """A state of a collection; number 0 is the empty one that every collection begins with."""

    path: str
    number: int = 0
    commit: str | None = None
    schema: T.StructType = T.StructType([])

    @property
    def data(self) -> str:
        return f"{self.path}/data"

    def manifest(self, spark: SparkSession) -> DataFrame:
        if not self.number:
            return spark.createDataFrame([], MANIFEST)
        return spark.read.schema(MANIFEST).parquet(f"{self.path}/manifests/{self.commit}")


def numbers(files: Files, path: str) -> list[int]:
    return sorted(int(n) for n in files.names(f"{path}/commits") if n.isdigit())


def snapshot(spark: SparkSession, path: str, number: int | None = None) -> Snapshot:
    """A collection's newest snapshot, or one that is still kept."""
    path, files = path.rstrip("/"), Files(spark)
    if number is None:
        number = max(numbers(files, path), default=0)
    if not number:
        return Snapshot(path)
    text = files.read_text(f"{path}/commits/{number:010d}")
    if text is None:
        raise FileNotFoundError(f"{path}: no snapshot {number}")
    found = json.loads(text)
    return Snapshot(path, number, found["commit"], T.StructType.fromJson(json.loads(found["schema"])))


def read_files(spark: SparkSession, of: Snapshot, paths: Iterable[str]) -> DataFrame:
    """Documents of some of a snapshot's folders or files."""
    paths, schema = list(paths), of.schema
    if not paths:
        return spark.createDataFrame([], schema)
    typed = T.StructType([*schema.fields, T.StructField(COMMIT, T.StringType())])
    return spark.read.schema(typed).option("basePath", of.data).parquet(*paths).select(*schema.names)


def read_snapshot(spark: SparkSession, of: Snapshot) -> DataFrame:
    """
    All documents of a snapshot. The frame reads its files and no others, whatever is committed later. The driver names the
    partition folders in force, one for each dataset and version, as Spark's own listing of the files does.
    """
    parts = of.manifest(spark).select(COMMIT, *PARTITIONS).distinct()
    return read_files(spark, of, [_folder(of, row) for row in parts.toLocalIterator()])


def _folder(of: Snapshot, row) -> str:
    values = ["__HIVE_DEFAULT_PARTITION__" if row[p] is None else row[p] for p in PARTITIONS]
    return f"{of.data}/{COMMIT}={row[COMMIT]}/{PARTITIONS[0]}={values[0]}/{PARTITIONS[1]}={values[1]}"


def documents_by_version(spark: SparkSession, of: Snapshot) -> DataFrame:
    """Document counts of every dataset and version, from the manifest alone."""
    return of.manifest(spark).groupBy(*PARTITIONS).agg(F.sum("documents").alias("documents"))


def read_id_ranges(spark: SparkSession, of: Snapshot, ranges: DataFrame) -> DataFrame:
    """
    Documents of the files that may hold ids above ``after`` and up to ``up_to`` of their dataset and version (the columns of
    ``ranges``). The manifest knows the least and greatest id of every file, so each dataset's own range decides which of
    its files are read; the documents still have to be filtered.
    """
    hit = of.manifest(spark).join(ranges, PARTITIONS).where("max_id > after AND min_id <= up_to").select(COMMIT, *PARTITIONS, "file").distinct()
    return read_files(spark, of, [f"{_folder(of, row)}/{row['file']}" for row in hit.toLocalIterator()])


def commit(spark: SparkSession, base: Snapshot, docs: DataFrame, replaced: DataFrame | None = None, keep: int = KEPT) -> Snapshot:
    """
    A new snapshot: the base less the ``replaced`` partitions (by default those of the documents), plus ``docs``, which must
    be of replaced partitions only.

    Documents go to a folder of this commit, sorted by partition and id and split by ranges of both, so that a file of a large
    partition holds a range of ids. Nothing that a reader uses changes. Then the manifest is written, and one small file,
    whose name only one writer can create, puts the commit in force: a partition without documents is simply not in it. A run
    that breaks off before leaves readers on the base. Of the snapshots the newest ``keep`` stay.

    Raises CommitConflict where another writer has committed since ``base``.
    """
    files, name = Files(spark), f"{base.number + 1:010d}-{uuid.uuid4().hex}"
    own, manifest = f"{base.data}/{COMMIT}={name}", f"{base.path}/manifests/{name}"
    known = {f.name for f in base.schema}
    schema = T.StructType([*base.schema.fields, *[T.StructField(f.name, T.LongType() if f.name in PARTITIONS else f.dataType) for f in docs.schema if f.name not in known]])
    columns = [F.col(f.name).cast(f.dataType) for f in schema if f.name in docs.columns]
    order = [*PARTITIONS, "id"]
    docs.select(*columns).repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(*PARTITIONS).parquet(own)

    stored = T.StructType([f for f in schema if f.name in order])
    added = spark.read.schema(stored).parquet(own).groupBy(*PARTITIONS, F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"))
    added = added.agg(F.count("*").alias("documents"), F.min("id").alias("min_id"), F.max("id").alias("max_id")).select(F.lit(name).alias(COMMIT), *PARTITIONS, "file", "documents", "min_id", "max_id")
    if base.number:
        gone = added if replaced is None else replaced
        stay = base.manifest(spark).join(gone.select(*PARTITIONS).distinct(), PARTITIONS, "left_anti")
        added = stay.select(*added.columns).unionByName(added)
    added.write.parquet(manifest)

    text = json.dumps({"commit": name, "schema": schema.json()})
    if not files.create_once(f"{base.path}/commits/{base.number + 1:010d}", text):
        files.delete(own)
        files.delete(manifest)
        raise CommitConflict(f"{base.path}: commit {base.number + 1} is taken")
    expire(spark, base.path, keep)
    return Snapshot(base.path, base.number + 1, name, schema)


def expire(spark: SparkSession, path: str, keep: int = KEPT) -> list[int]:
    """
    Drop all snapshots but the newest ``keep``, with the partition folders that only they use and whatever runs that broke
    off left behind before the oldest one kept. Frames that were read from a dropped snapshot are void. Returns their numbers.
    """
    files = Files(spark)
    have = numbers(files, path)
    old, kept = have[:-keep], [snapshot(spark, path, n) for n in have[-keep:]]
    if not old:
        return []
    used = kept[0].manifest(spark)
    for other in kept[1:]:
        used = used.unionByName(other.manifest(spark))
    used = used.select(COMMIT, *PARTITIONS).distinct()
    for number in old:
        dropped = snapshot(spark, path, number)
        unused = dropped.manifest(spark).select(COMMIT, *PARTITIONS).distinct().join(used, [COMMIT, *PARTITIONS], "left_anti")
        for row in unused.toLocalIterator():
            files.delete(_folder(dropped, row))
        files.delete(f"{path}/commits/{number:010d}")
        files.delete(f"{path}/manifests/{dropped.commit}")
    live = {row[0] for row in used.select(COMMIT).distinct().toLocalIterator()} | {s.commit for s in kept}
    for folder, start in (("data", len(COMMIT) + 1), ("manifests", 0)):
        for name in files.names(f"{path}/{folder}"):
            token = name[start:]
            if token not in live and int(token.split("-")[0]) < kept[0].number:
                files.delete(f"{path}/{folder}/{name}")
    return old
