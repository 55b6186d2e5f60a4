"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the jobs rely on. Joins carry no broadcast hints: Spark compares measured sizes with
# spark.sql.autoBroadcastJoinThreshold (and its adaptive twin) and falls back to a sort-merge join beyond it.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

_local_root: str | None = None


def get_session(app: str = "tidemark", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach; a machine-local one is accepted in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="tidemark-")
    return _local_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, never reused path below the shared folder."""
    return f"{scratch_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


@contextmanager
def own_shuffles_only(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove their shuffle files when they end, so that the disk holds those of one write at a time.

    A write has a plan of its own, whose shuffles nothing else reads.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared folder and read it back: fixes its rows and cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, label: str, *keys: str) -> DataFrame:
    """Like ``materialize``, in one bucket for each shuffle partition, so that joins and groups by the keys need no shuffle.

    The shuffles it takes to write it don't stay on disk.
    """
    spark = df.sparkSession
    buckets, path = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch_path(spark, label)
    table = f"{label}_{path[-32:]}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    with own_shuffles_only(spark):
        writer.format("parquet").option("compression", "zstd").option("path", path).saveAsTable(table)
    return spark.table(table)
