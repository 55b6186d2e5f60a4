"""Table writers: atomic replacement, append-only history, day partitions, statistics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import Files


def save_table(df: DataFrame, table: str, path: str | None = None, analyze: bool = True) -> DataFrame:
    """Overwrite an ORC table, gather its statistics and return it."""
    spark = df.sparkSession
    writer = df.write.mode("overwrite").format("orc")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    if analyze:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    return spark.table(table)


VERSION = "v="


def replace_table(df: DataFrame, table: str, root: str | None = None) -> DataFrame:
    """Replace a table by a complete new copy in a folder of its own, by moving the table's location.

    The rows are written to the next version's folder below ``root`` (by default beside the warehouse's tables), and one
    metastore call then points the table there: readers see all old rows or all new ones, and there is no moment without
    a table. Columns that are new are added before, and are null in the old rows. The copy that was replaced stays for running
    readers until the next replacement; what a broken run left, complete or not, goes then as well. The table's data are never
    touched before the new copy is complete. Only a table that loses columns or changes their types or order is made anew, from
    the finished copy.
    """
    spark, files = df.sparkSession, Files(df.sparkSession)
    root = (root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_versions").rstrip("/") + f"/{table.replace('.', '/')}"
    old = table_location(spark, table) if spark.catalog.tableExists(table) else None
    numbers = [int(n[len(VERSION):]) for n in files.names(root) if n.startswith(VERSION)]
    path = f"{root}/{VERSION}{max(numbers, default=0) + 1}"
    df.write.format("orc").save(path)
    if old is None:
        spark.sql(f"CREATE TABLE {table} USING orc LOCATION '{path}'")
    else:
        _move_location(spark, table, path)
    spark.catalog.refreshTable(table)
    kept = {path.rsplit("/", 1)[1], (old or "").rstrip("/").rsplit("/", 1)[1] if old and _below(old, root) else None}
    for name in files.names(root):
        if name.startswith(VERSION) and name not in kept:
            files.delete(f"{root}/{name}")
    return spark.table(table)


def _below(path: str, root: str) -> bool:
    return path.split(":", 1)[-1].lstrip("/").startswith(root.split(":", 1)[-1].lstrip("/") + "/")


def table_location(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").select("data_type").first()
    return found[0]


def _move_location(spark: SparkSession, table: str, path: str) -> None:
    have = [(f.name, f.dataType) for f in spark.table(table).schema]
    wanted = [(f.name, f.dataType) for f in spark.read.orc(path).schema]
    if have != wanted[: len(have)]:
        spark.sql(f"DROP TABLE {table}")
        spark.sql(f"CREATE TABLE {table} USING orc LOCATION '{path}'")
        return
    if wanted[len(have) :]:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{n}` {t.simpleString()}' for n, t in wanted[len(have):])})")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")


def with_load_time(df: DataFrame, load_time: str) -> DataFrame:
    return df.withColumn("ts_inserimento", F.lit(load_time).cast("timestamp"))


def append_history(df: DataFrame, path: str, load_time: str) -> None:
    """Append today's rows with their load time."""
    with_load_time(df, load_time).write.mode("append").orc(path)


def snapshot(df: DataFrame, path: str, load_time: str) -> None:
    """Overwrite the current rows and append the same rows to the history."""
    current = f"{path}/current"
    df.write.mode("overwrite").orc(current)
    append_history(df.sparkSession.read.schema(df.schema).orc(current), f"{path}/history", load_time)


def append_by_day(df: DataFrame, path: str, keys: Sequence[str] = ("year", "month", "day")) -> None:
    """Append into day partitions; a large day is split over several tasks, small ones share one."""
    df.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).orc(path)


def replace_batch(df: DataFrame, path: str, keys: Sequence[str], batch: str) -> None:
    """Write a batch's rows into partitions that end with the batch, in place of those that it wrote there before."""
    arranged = df.hint("rebalance", *keys, batch)
    arranged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys, batch).orc(path)


class StateConflict(RuntimeError):
    """Another writer has stored a newer state meanwhile."""


class StateTable:
    """A small table kept as numbered complete copies; the newest committed copy is the current state.

    A copy is written in full before readers can choose it, so a lost job leaves the previous state in force. Its number is taken
    by creating a small file that only one writer can create: of two that began from the same state, the second is told, and
    ``update`` begins again from the newer state.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema, self.files = spark, path.rstrip("/"), schema, Files(spark)

    def _versions(self) -> list[int]:
        return sorted(int(n[2:]) for n in self.files.names(self.path) if n.startswith("n=") and n[2:].isdigit())

    def _folder(self, number: int) -> str:
        return f"{self.path}/{self.files.read_text(f'{self.path}/n={number}')}"

    def _read(self, number: int) -> DataFrame:
        if not number:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._folder(number))

    def read(self) -> DataFrame:
        return self._read(max(self._versions(), default=0))

    def write(self, df: DataFrame, after: int | None = None) -> None:
        """Store a state, the one after number ``after`` (by default after the newest)."""
        versions = self._versions()
        number = (max(versions, default=0) if after is None else after) + 1
        folder = f"copy={number}-{uuid.uuid4().hex}"
        df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).write.parquet(f"{self.path}/{folder}")
        if not self.files.create_once(f"{self.path}/n={number}", folder):
            self.files.delete(f"{self.path}/{folder}")
            raise StateConflict(f"{self.path}: state {number} is stored already")
        for old in versions[:-1]:  # the one before the new one stays for its readers
            self.files.delete(self._folder(old))
            self.files.delete(f"{self.path}/n={old}")

    def update(self, change: Callable[[DataFrame], DataFrame], tries: int = 10) -> DataFrame:
        """Store what ``change`` makes of the newest state; begin again where another writer was faster."""
        for turn in range(tries):
            newest = max(self._versions(), default=0)
            try:
                self.write(change(self._read(newest)), newest)
                return self.read()
            except StateConflict:
                if turn == tries - 1:
                    raise
        raise AssertionError("tries must be positive")
