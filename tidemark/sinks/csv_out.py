"""CSV exports with the platform's file naming, and delimited reports."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import Files
from tidemark.functions.objectid import part_id
from tidemark.functions.paths import export_file_name
from tidemark.session import materialize
from tidemark.sources.listing import file_sizes

ROWS_PER_FILE = 5_000_000
BYTES_PER_REPORT_FILE = 64 << 20

# Columns of the toolkit beside those of a data set: no field may begin like this.
RESERVED = "__tm_"
PART, TURN = f"{RESERVED}part", f"{RESERVED}turn"


def refuse_reserved(columns: Sequence[str]) -> None:
    """Fields that begin like the toolkit's own columns can't be told from them."""
    taken = [c for c in columns if c.lower().startswith(RESERVED)]
    if taken:
        raise ValueError(f"columns must not begin with {RESERVED}: {taken}")


def csv_writer(df: DataFrame) -> DataFrameWriter:
    """Header, quotes only where needed, null and empty text kept apart, blanks untouched."""
    writer = df.write.option("header", True).option("escape", '"')
    return writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def write_in_files(
    rows: DataFrame, sizes: DataFrame, keys: Sequence[str], path: str, rows_per_file: int = ROWS_PER_FILE
) -> DataFrame:
    """Write one CSV per key, or several of about equal size for a key with more than ``rows_per_file`` rows.

    ``rows`` holds the keys under their reserved names (``__tm_<key>``) and the number ``__tm_turn``, which deals the
    rows of a large key out to its files; it must not depend on the order rows arrive in, and copies of a row must not
    share it. ``sizes`` holds the row count of every key (column ``rows``). One key and part go to one task, which
    holds about ``rows_per_file`` rows whatever the key. Returns the files, see ``write_counted``.
    """
    own = [RESERVED + key for key in keys]
    wanted = F.greatest(F.ceil(F.col("rows") / rows_per_file), F.lit(1)).cast("bigint")
    parts = sizes.select(*[F.col(k).alias(RESERVED + k) for k in keys], "rows", wanted.alias(f"{RESERVED}parts"))
    total, files = parts.agg(F.sum("rows"), F.sum(f"{RESERVED}parts")).first()
    dealt = rows.join(parts.drop("rows"), own, "inner").withColumn(PART, F.pmod(TURN, f"{RESERVED}parts")).drop(f"{RESERVED}parts")
    return write_counted(dealt, keys, write_tasks(rows.sparkSession, files or 0, (total or 0) / rows_per_file), path)


def write_counted(dealt: DataFrame, keys: Sequence[str], tasks: int, path: str) -> DataFrame:
    """Write one CSV per key and part, and count its rows in the same pass: keys, part, file, rows.

    Rows of a file are numbered as they are sorted for the writer, and the last one's number is reported with the finished
    job, one entry a file. The files are not read again; only their names are listed.
    """
    spark, own = dealt.sparkSession, [*[RESERVED + key for key in keys], PART]
    number, last, counts = f"{RESERVED}number", f"{RESERVED}last", Observation()
    in_file = Window.partitionBy(*own).orderBy(TURN)
    numbered = dealt.repartition(tasks, *own).withColumns({number: F.row_number().over(in_file), last: F.lead(F.lit(1)).over(in_file).isNull()})
    entry = F.struct(*[F.col(c).cast("bigint").alias(n) for c, n in zip(own, [*keys, "part"], strict=True)], F.col(number).cast("bigint").alias("rows"))
    numbered = numbered.observe(counts, F.collect_list(F.when(F.col(last), entry)).alias("files")).drop(number, last, TURN)
    csv_writer(numbered).option("maxRecordsPerFile", 0).partitionBy(*own).csv(path)

    schema = ", ".join(f"`{k}` bigint" for k in [*keys, "part", "rows"])
    counted = spark.createDataFrame([tuple(r) for r in counts.get["files"]], schema)
    if not Files(spark).exists(path):
        return counted.select(*keys, F.col("part").cast("int").alias("part"), F.lit(None).cast("string").alias("file"), "rows")
    listed = file_sizes(spark, path, "*.csv").select(F.col("path").alias("file"))
    labels = [F.regexp_extract("file", f"/{RESERVED}{k}=([^/]+)/", 1).cast("bigint").alias(k) for k in [*keys, "part"]]
    return listed.select("file", *labels).join(counted, [*keys, "part"]).select(*keys, F.col("part").cast("int").alias("part"), "file", "rows")


def write_tasks(spark: SparkSession, files: int, full_files: float) -> int:
    """Tasks of a keyed write: the session's shuffle parallelism, more for more full files, never more than files."""
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(files, max(usual, math.ceil(full_files))))


def publish_files(files: DataFrame, folder: Column, oid: Column, code: Column, version: Column) -> list[str]:
    """Move written files under their final names ``<oid>_<rows>-<code>-<version>.csv``.

    Names are streamed to the driver, one per file; renames do not touch the contents. A repeated run replaces its own files.
    Returns the final paths.
    """
    plan = final_names(files, folder, oid, code, version)
    return Files(files.sparkSession).rename_all(((row["source"], row["target"]) for row in plan.toLocalIterator()), replace=True)


def final_names(files: DataFrame, folder: Column, oid: Column, code: Column, version: Column) -> DataFrame:
    """source and target of every written file."""
    name = export_file_name(part_id(oid, F.col("part")), F.col("rows"), code, version)
    return files.select(F.col("file").alias("source"), F.concat_ws("/", folder, name).alias("target"))


# as the CSV writer prints times with and without a zone
TIMES = {T.TimestampType: "yyyy-MM-dd'T'HH:mm:ss.SSSXXX", T.TimestampNTZType: "yyyy-MM-dd'T'HH:mm:ss.SSS"}


def report_lines(df: DataFrame, sep: str = ";") -> tuple[str, Column]:
    """Header and the line of each row: text, times and flags between quotes, numbers without, nulls as nothing.

    Quotes inside a value are doubled, so empty text (``""``) and null stay apart.
    """

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))

    values = []
    for field in df.schema:
        value = F.col(f"`{field.name}`")
        time = TIMES.get(type(field.dataType))
        text = F.date_format(value, time) if time else value.cast("string")
        values.append(F.coalesce(text if isinstance(field.dataType, T.NumericType) else quoted(text), F.lit("")))
    names = sep.join('"' + c.replace('"', '""') + '"' for c in df.columns)
    return names, F.concat_ws(sep, *values)


_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id keeps the row's place in its partition there


def write_report(df: DataFrame, path: str, single_file: bool = False, bytes_per_file: int = BYTES_PER_REPORT_FILE) -> None:
    """Semicolon separated report, values by their types (see ``report_lines``), in the report's order, each file with a header.

    ``single_file`` gathers the finished report in one file, or, where it is larger than ``bytes_per_file``, in files of about
    that size: its lines are written down with their places in the order, which the writing tasks get ranges of. Otherwise each
    file holds one range of the order. A report without rows is one file that holds the header.
    """
    header, line = report_lines(df)
    lines = df.select(line.alias("value"), F.monotonically_increasing_id().alias("place"))
    if single_file:
        lines = materialize(lines, "report")
        size = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0
        ranges = lines.repartitionByRange(max(1, math.ceil(size / bytes_per_file)), "place").sortWithinPartitions("place")
        lines = ranges.select("value", F.monotonically_increasing_id().alias("place"))
    first = F.col("place").bitwiseAND(_LOW_BITS) == 0
    headed = lines.select(F.when(first, F.concat_ws("\n", F.lit(header), "value")).otherwise(F.col("value")).alias("value"))
    headed.write.mode("overwrite").option("compression", "none").text(path)
    files = Files(df.sparkSession)
    if not any(f["length"] for f in files.details(path)):
        files.write_text(f"{path}/part-header.txt", header + "\n")
