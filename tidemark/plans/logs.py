"""Access logs: fixed layouts, day partitions, call accounting."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.sinks.tables import replace_batch
from tidemark.sources.csv_files import read_feed_csv

# Column order of the four header-less layouts.
LAYOUTS = {
    "odata": (
        "id_api", "forwarded_for", "jwt", "local_ip", "host_port", "client_ip", "remote_logname", "remote_user",
        "log_timestamp", "risorsa", "query", "status_ret", "refer", "useragent", "byte_in", "byte_out",
        "elapsed_microsec",
    ),
    "amq": (
        "log_timestamp", "uniqueid", "connectionId", "protocol", "username", "tenant", "destination", "operation",
        "ipOrigin", "sensorStream", "numeroEventi", "elapsed", "error",
    ),
    "esb": (
        "log_timestamp", "uniqueid", "connid", "protocol", "tenant", "destination", "operation", "iporigin",
        "sensor_stream", "numevents", "elapsed", "error",
    ),
    "intapi": (
        "log_timestamp", "uniqueid", "forwardedfor", "jwt", "path", "apicode", "datasetcode", "tenant", "query",
        "nrecin", "nrecout", "elapsed", "error_bsn", "error_servlet",
    ),
}

# Feed -> layout. A site puts its own prefix before the name; folders use dashes.
FEEDS = {
    "intapi": "odata",
    "stream1_apache": "odata",
    "stream2_apache": "odata",
    "web1": "odata",
    "web2": "odata",
    "stream1_amq": "amq",
    "stream2_amq": "amq",
    "esbin1": "esb",
    "esbin2": "esb",
    "intapi1_ajb620": "intapi",
    "intapi2_ajb620": "intapi",
    "intapi1_odata": "intapi",
    "intapi2_odata": "intapi",
}

DAY = ["year", "month", "day"]


# folder below a feed's that holds the batches being loaded
LOADING = "loading"
# partition column of the loaded tables: the batch a row came with
BATCH = "batch"


def feed_folder(root: str, feed: str) -> str:
    return f"{root}/{feed.replace('_', '-')}"


def with_day(logs: DataFrame) -> DataFrame:
    """Add unix_ts, year, month and day of the text timestamp; all null when it cannot be read."""
    second = F.regexp_replace(F.substring("log_timestamp", 1, 19), "T", " ")
    unix_ts = F.unix_seconds(F.try_to_timestamp(second, F.lit("yyyy-MM-dd HH:mm:ss")))
    date = F.col("log_timestamp").try_cast("date")
    return logs.select(
        "*", unix_ts.alias("unix_ts"), F.year(date).alias("year"), F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
    )


def read_feed(spark: SparkSession, path: str, layout: str) -> DataFrame:
    return with_day(read_feed_csv(spark, path, LAYOUTS[layout]))


class FeedLedger:
    """Which files of a feed went into which batch, and which batches are loaded: small texts beside the feed's table."""

    def __init__(self, spark: SparkSession, path: str):
        self.path, self.files = path.rstrip("/"), Files(spark)

    def _numbers(self, mark: str) -> set[int]:
        return {int(n.split(".")[0]) for n in self.files.names(self.path) if n.endswith(mark)}

    def open(self) -> list[int]:
        """Batches that were begun and not finished, oldest first."""
        return sorted(self._numbers(".begun") - self._numbers(".loaded"))

    def begin(self) -> int:
        """Claim the next number; of several jobs each gets its own."""
        number = max(self._numbers(".begun"), default=0) + 1
        while not self.files.create_once(f"{self.path}/{number:010d}.begun", ""):
            number += 1
        return number

    def list_files(self, number: int, found: list[dict]) -> None:
        """The batch's files as they are before they are loaded."""
        self.files.write_text(f"{self.path}/{number:010d}.files", json.dumps(sorted(found, key=lambda f: f["path"])))

    def finish(self, number: int) -> None:
        self.files.write_text(f"{self.path}/{number:010d}.loaded", "")

    def consumed(self) -> list[dict]:
        """path, length, time and batch of every file of the loaded batches."""
        out = []
        for number in sorted(self._numbers(".loaded")):
            text = self.files.read_text(f"{self.path}/{number:010d}.files")
            out += [{**f, BATCH: number} for f in json.loads(text or "[]")]
        return out


def ingest_feeds(
    spark: SparkSession, root: str, target: str, feeds: dict[str, str] | None = None, prefix: str = ""
) -> dict[str, str]:
    """Load every feed into its day-partitioned table and consume its files, each file exactly once; a feed that fails is
    reported, with its files in place, and the others go on.

    The files to load are moved to a folder of a new batch, so what arrives meanwhile, of whatever name, waits for the next
    run. A batch is the last partition level of the table: loading it again replaces its own rows and no others. The ledger
    says which batches are loaded; a run first repeats those that an earlier one began and did not finish, from the
    files that lie in their folders. Files are deleted once their batch is marked as loaded.
    """
    failed, disk = {}, Files(spark)
    for name, layout in (feeds or FEEDS).items():
        feed = prefix + name
        folder = feed_folder(root, feed)
        ledger = FeedLedger(spark, f"{target}/_ledger/{feed}")
        try:
            if not disk.exists(folder):
                raise FileNotFoundError(folder)
            _take_strays(disk, ledger, f"{folder}/{LOADING}")
            for batch in ledger.open():
                _load_batch(spark, disk, ledger, f"{folder}/{LOADING}/{batch:010d}", batch, layout, f"{target}/{feed}_partday")
            arrived = [n for n in disk.names(folder) if n != LOADING]
            if arrived:
                batch = ledger.begin()
                loading = f"{folder}/{LOADING}/{batch:010d}"
                disk.rename_all((f"{folder}/{n}", f"{loading}/{n}") for n in arrived)
                _load_batch(spark, disk, ledger, loading, batch, layout, f"{target}/{feed}_partday")
            for batch in disk.names(f"{folder}/{LOADING}"):  # loaded, but not deleted
                disk.delete(f"{folder}/{LOADING}/{batch}")
        except (PySparkException, Py4JJavaError, OSError) as problem:
            failed[feed] = str(problem)
    return failed


def _take_strays(disk: Files, ledger: FeedLedger, loading: str) -> None:
    """Files that lie in the loading folder itself belong to no batch yet; they become one of their own."""
    strays = [n for n in disk.names(loading) if disk.is_file(f"{loading}/{n}")]
    if strays:
        batch = ledger.begin()
        disk.rename_all((f"{loading}/{n}", f"{loading}/{batch:010d}/{n}") for n in strays)


def _load_batch(spark: SparkSession, disk: Files, ledger: FeedLedger, loading: str, batch: int, layout: str, table: str) -> None:
    found = disk.details(loading)
    ledger.list_files(batch, found)
    if found:  # a run may have broken off before it moved the first file
        rows = read_feed(spark, loading, layout).withColumn(BATCH, F.lit(batch).cast("bigint"))
        replace_batch(rows, table, DAY, BATCH)
    ledger.finish(batch)
    disk.delete(loading)


def call_pairs(logs: DataFrame, datasets: DataFrame, server: str = "odataintapi1") -> DataFrame:
    """Join each incoming call with the internal call it caused (same request id), one row per pair.

    The incoming row has a forwarded address, the internal one has ``-``. Tenant and dataset of the internal row
    are looked up by API code where they hold the placeholders ``-`` or ``|``. Rows whose request id is a placeholder
    belong to no pair.
    """
    logs = logs.where(~F.col("uniqueid").isin("-", "|"))
    caller = logs.where(F.col("forwardedfor") != "-").select(
        "uniqueid", "forwardedfor", "jwt", "query", "elapsed",
        F.col("error_bsn").alias("e1_bsn"), F.col("error_servlet").alias("e1_servlet"),
    )
    known = datasets.select(F.col("datasetcode").alias("apicode"), F.col("tenantcode").alias("_tenant"))

    def resolved(column: str, found: str):
        return F.when(F.col(column).isin("-", "|"), F.col(found)).otherwise(F.col(column)).alias(column)

    callee = logs.where(F.col("forwardedfor") == "-").join(known, "apicode").select(
        "uniqueid", "log_timestamp", "path", "apicode", resolved("datasetcode", "apicode"), resolved("tenant", "_tenant"),
        "nrecin", "nrecout", F.col("error_bsn").alias("e2_bsn"), F.col("error_servlet").alias("e2_servlet"), "unix_ts", *DAY,
    )
    return callee.join(caller, "uniqueid").select(
        F.lit(server).alias("servercode"), "log_timestamp", "uniqueid", "forwardedfor", "jwt", "path", "apicode",
        "datasetcode", "tenant", "query", "nrecin", "nrecout", "elapsed", "e1_bsn", "e1_servlet", "e2_bsn",
        "e2_servlet", "unix_ts", *DAY,
    )
