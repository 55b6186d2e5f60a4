"""What the operators share: session settings, written tables, Arrow slices and numbering along an order."""

from __future__ import annotations

import atexit
import gc
import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import tidemark
from tidemark.session import apply_settings, scratch_path

# An Arrow batch holds whole rows; texts may be long, so few rows go into one.
ARROW_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}

_written: list[tuple[SparkSession, str]] = []


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, whose Python may not have it. Once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top, content = Path(tidemark.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(content, "w") as out:
        for file in sorted(top.rglob("*.py")):
            out.write(file, file.relative_to(top.parent))
    path = f"{new_path(spark, 'sources')}/tidemark_sources.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(context._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(content.getvalue()))
    finally:
        stream.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def ready(spark: SparkSession) -> SparkSession:
    apply_settings(spark)
    ship_package(spark)
    for key, value in ARROW_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_written() -> None:
    """Delete every table that `written` made in this application; frames that read them are void afterwards."""
    while _written:
        spark, path = _written.pop()
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone; the folder's retention rule takes over
            return


atexit.register(clear_written)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = scratch_path(spark, f"llm-{label}")
    _written.append((spark, path))
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read back: rows are fixed, lineage is cut, lost executors cost nothing."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that `written` made and that no frame will read any more."""
    for table in tables:
        delete_path(table.sparkSession, table.written_path)
        _written[:] = [w for w in _written if w[1] != table.written_path]


@contextmanager
def tables_made() -> Iterator[list[str]]:
    """The paths that `new_path` gives out inside the block."""
    have, made = {path for _, path in _written}, []
    yield made
    made += [path for _, path in _written if path not in have]


def delete_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete intermediate tables that no frame will read any more; those deleted already are passed over."""
    have = {path for _, path in _written}
    for path in paths:
        if path in have:
            delete_path(spark, path)
    gone = set(paths)
    _written[:] = [w for w in _written if w[1] not in gone]


def release(spark: SparkSession) -> None:
    """A workaround: let Spark delete the shuffle files of finished jobs now, not whenever the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def need(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, cast; a column that is absent is null. Extra columns can't clash with the operator's own."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


BLOOM_BITS = 24


def bloom(keys: DataFrame, column: str) -> np.ndarray:
    """
    Which of 2^24 remainders the values of a bigint column have, as packed bits. Spark builds it in pieces of 4 KB; its size
    is fixed, so it may be sent to every task. A full one lets everything pass, and the join behind it decides.
    """
    size = 1 << BLOOM_BITS
    place = f"pmod(`{column}`, {size}) + 1"
    pieces = keys.groupBy(F.expr(f"bitmap_bucket_number({place})").alias("bucket")).agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({place}))").alias("bits")).collect()
    field = np.zeros(size, bool)
    for row in pieces:
        own = np.unpackbits(np.frombuffer(row["bits"], np.uint8), bitorder="little")
        field[(row["bucket"] - 1) * len(own) : row["bucket"] * len(own)] = own
    return np.packbits(field)


def bloom_field(packed: np.ndarray) -> np.ndarray:
    return np.unpackbits(packed).astype(bool)


def in_bloom(field: np.ndarray, values: np.ndarray) -> np.ndarray:
    return field[values.view(np.int64) & ((1 << BLOOM_BITS) - 1)]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row bounds of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(bounds: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes each; a longer row is a range of its own."""
    n, at = len(bounds) - 1, 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1)
        yield at, min(to, n)
        at = min(to, n)


def running_totals(df: DataFrame, order: list[Column | str], values: list[str], label: str) -> DataFrame:
    """
    Add ``before_<v>``: the sum of v over all rows that come earlier in the order. Rows are dealt by ranges of the order
    (give it enough columns that no single key is large), summed inside each range as they are written, and shifted by
    the totals of the ranges before, one row a range.
    """
    kept = df.schema
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", _part int" + "".join(f", `before_{v}` bigint" for v in values)

    def run(batches):
        part = TaskContext.get().partitionId()
        total = dict.fromkeys(values, 0)
        for batch in batches:
            table = pa.Table.from_batches([batch]).append_column("_part", pa.array(np.full(batch.num_rows, part, np.int32)))
            for v in values:
                own = batch.column(v).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
                ends = total[v] + np.cumsum(own)
                table = table.append_column(f"before_{v}", pa.array(ends - own))
                total[v] = int(ends[-1]) if len(ends) else total[v]
            yield from table.to_batches()

    parts = written(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), label)
    ends = parts.groupBy("_part").agg(*[F.max(F.col(f"before_{v}") + F.coalesce(F.col(v), F.lit(0))).alias(f"_end_{v}") for v in values])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("_part", *[F.coalesce(F.sum(f"_end_{v}").over(earlier), F.lit(0)).alias(f"_base_{v}") for v in values])
    # One row for each range, so its size is bounded by the number of partitions.
    joined = parts.join(F.broadcast(base), "_part")
    return joined.select(*[f"`{f.name}`" for f in kept], *[(F.col(f"before_{v}") + F.col(f"_base_{v}")).alias(f"before_{v}") for v in values])
