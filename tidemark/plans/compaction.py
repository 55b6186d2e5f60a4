"""Monthly compaction of small raw CSV files."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.functions.objectid import id_month, id_year
from tidemark.session import materialize, scratch_path
from tidemark.sinks.csv_out import PART, RESERVED, TURN, final_names, refuse_reserved, write_counted, write_tasks
from tidemark.sources.csv_files import read_raw_csv
from tidemark.sources.listing import raw_csv_files

BYTES_PER_FILE = 1 << 30
GROUP = ["folder", "datasetcode", "datasetversion", "year", "month"]
MOVES = "_moves"


class CompactionMismatch(RuntimeError):
    """The compacted files do not hold the rows of their sources."""


def with_month(files: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """Year and month of the object id in the file name."""
    return files.withColumn("year", id_year(F.col("oid"), time_zone)).withColumn("month", id_month(F.col("oid"), time_zone))


def file_groups(files: DataFrame, bytes_per_file: int = BYTES_PER_FILE) -> DataFrame:
    """Months with more files than they need: one, or one per ``bytes_per_file`` for a very large month.

    File names are counted, not gathered: a month is described by its totals and its highest object id.
    """
    groups = files.groupBy(*GROUP).agg(
        F.count("*").alias("files"), F.sum("byte").alias("byte"), F.max("oid").alias("max_oid")
    )
    wanted = F.greatest(F.ceil(F.col("byte") / bytes_per_file), F.lit(1)).cast("bigint")
    return groups.withColumn("parts", wanted).where(F.col("files") > F.col("parts"))


def drop_repeated_headers(rows: DataFrame, marker: str = "time") -> DataFrame:
    """Header lines in the middle of a file carry the column's own name; rows without a time are kept."""
    return rows.where(~F.col(marker).eqNullSafe(F.lit(marker)))


def compact(
    spark: SparkSession, root: str, archive: str, columns: Sequence[str], marker: str | None = "time",
    time_zone: str = "UTC", bytes_per_file: int = BYTES_PER_FILE,
) -> list[str]:
    """Compact every crowded month of the datasets below ``root`` that share one column list, in one plan.

    The new files are written and counted first; then all moves are written down, the sources move to ``archive``
    and the new files take their places. A run that breaks between them is finished by the next one. ``marker`` names
    the column that betrays repeated headers (None for bulk and binary data). The files' own columns may have any name
    that does not begin like the toolkit's.
    """
    refuse_reserved(columns)
    finish_moves(spark, archive)
    found = materialize(with_month(raw_csv_files(spark, root), time_zone), "rawfiles")
    groups = materialize(file_groups(found, bytes_per_file).withColumn("group_id", F.xxhash64(*GROUP)), "groups")
    if groups.count() != groups.select("group_id").distinct().count():
        raise CompactionMismatch("two months share a group number")
    sources = found.join(groups.select(*GROUP, "group_id"), GROUP).select("path", "file_name", "group_id")
    sources = materialize(sources, "sources")
    paths = [row["path"] for row in sources.select("path").toLocalIterator()]
    if not paths:
        return []

    rows = read_raw_csv(spark, paths, columns, multi_line=True)
    path, group, parts = f"{RESERVED}path", f"{RESERVED}group_id", f"{RESERVED}parts"
    rows = rows.select(*[f"`{c}`" for c in columns], F.col("_metadata.file_path").alias(path), F.monotonically_increasing_id().alias(TURN))
    if marker:
        rows = drop_repeated_headers(rows, marker)
    places = sources.join(groups.select("group_id", "parts"), "group_id")
    rows = rows.join(places.select(F.col("path").alias(path), F.col("group_id").alias(group), F.col("parts").alias(parts)), path)
    read = Observation()
    stage = scratch_path(spark, "compact")
    dealt = rows.observe(read, F.count(F.lit(1)).alias("rows")).withColumn(PART, F.pmod(TURN, parts)).select(*[f"`{c}`" for c in columns], group, PART, TURN)
    files, size = groups.agg(F.sum("parts"), F.sum("byte")).first()
    tasks = write_tasks(spark, files, size / bytes_per_file)
    written = materialize(write_counted(dealt, ["group_id"], tasks, stage), "compacted")
    if read.get["rows"] != (written.agg(F.sum("rows")).first()[0] or 0):
        _compare(rows, group, written)

    named = written.join(groups.select("group_id", "folder", "max_oid", "datasetcode", "datasetversion"), "group_id")
    named = final_names(named, F.col("folder"), F.col("max_oid"), F.col("datasetcode"), F.col("datasetversion"))
    run = uuid.uuid4().hex
    away = sources.select(F.col("path").alias("source"), F.concat_ws("/", F.lit(archive), F.lit(run), F.col("group_id").cast("string"), "file_name").alias("target"))
    write_moves(away, named, archive)
    return finish_moves(spark, archive)


def _compare(rows: DataFrame, group: str, written: DataFrame) -> None:
    """Read the sources again: tasks that ran twice count twice on the way to the writer, rows that got lost do not."""
    expected = rows.groupBy(F.col(group).alias("group_id")).agg(F.count("*").alias("expected"))
    arrived = written.groupBy("group_id").agg(F.sum("rows").alias("found"))
    wrong = expected.join(arrived, "group_id", "left").where(~F.col("expected").eqNullSafe(F.col("found"))).take(5)
    if wrong:
        raise CompactionMismatch(f"rows read and compacted differ: {wrong}")


def write_moves(away: DataFrame, into_place: DataFrame, archive: str) -> None:
    """
    Write the moves down, sources first: from here on the next run can finish what this one leaves. Sources go to a folder of
    the run's own, so a file that lies there has been moved by this run, whatever has its old name now.
    """
    moves = away.withColumn("turn", F.lit(0)).unionByName(into_place.withColumn("turn", F.lit(1)))
    moves.write.mode("overwrite").json(f"{archive}/{MOVES}")


def finish_moves(spark: SparkSession, archive: str) -> list[str]:
    """Do the moves written down that are not done yet; the places of the new files."""
    disk, path = Files(spark), f"{archive}/{MOVES}"
    if not disk.exists(path):
        return []
    if not disk.is_complete(path):  # nothing has moved before the moves were complete
        disk.delete(path)
        return []
    moves = spark.read.schema("source string, target string, turn int").json(path)
    archived, placed = (moves.where(F.col("turn") == turn) for turn in (0, 1))
    # First the sources: a new file may take the name of one of them, and then isn't moved away again.
    disk.rename_all((row["source"], row["target"]) for row in archived.toLocalIterator() if not disk.exists(row["target"]))
    disk.rename_all((row["source"], row["target"]) for row in placed.toLocalIterator() if disk.exists(row["source"]))
    done = [row["target"] for row in moves.where("turn = 1").toLocalIterator()]
    disk.delete(path)
    return done
