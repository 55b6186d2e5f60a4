"""Jobs that write: serving collections, exports, promotion, compaction, logs, alignment state.

Every run writes below a new scratch path and returns what it reads back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness.queries_core import LAKE_FIELDS
from harness.registry import plain_types, query
from harness.views import DUCK_VIEWS, Inputs
from tidemark.files import Files
from tidemark.functions.objectid import id_from_time
from tidemark.functions.paths import export_file_name
from tidemark.plans import compaction, export, incremental, logs, promote, publish, state
from tidemark.session import scratch_path
from tidemark.sinks import serving as store
from tidemark.sinks.csv_out import csv_writer
from tidemark.sinks.stats import append_stats, stats_rows
from tidemark.sinks.tables import append_by_day
from tidemark.sources.csv_files import read_raw_csv
from tidemark.sources.listing import file_sizes, folder_sizes, name_parts
from tidemark.sources.serving import count_by_version, read_collection, serving_scan, stream_collection
from tidemark.sources.snapshots import snapshot
from tidemark.sources.tables import scan_dataset
from tidemark.streaming.incremental import start_incremental_export
from tidemark.streaming.logs import log_stream, start_log_ingest

# ---------------------------------------------------------------- serving collections


def _collection(t: Inputs, docs: DataFrame) -> str:
    path = scratch_path(t.spark, "collection")
    store.write_partitions(docs, path)
    return path


@query(
    "serving_scan",
    """SELECT id, iddataset_l, datasetversion_l, origin_s, CAST(time_dt AS string) AS time_dt, type_s, value_d, note_s
       FROM {x_doc} WHERE iddataset_l = 4 AND datasetversion_l = 2""",
)
def serving_scan_query(t: Inputs) -> DataFrame:
    return plain_types(serving_scan(t.spark, _collection(t, t("x_doc")), 4, 2))


@query(
    "serving_scan_pruned",
    "SELECT id, value_d FROM {x_doc} WHERE iddataset_l = 3 AND datasetversion_l = 2 AND value_d > 20",
)
def serving_scan_pruned(t: Inputs) -> DataFrame:
    return serving_scan(t.spark, _collection(t, t("x_doc")), 3, 2, ["id", "value_d"]).where("value_d > 20")


# changed documents: purchases twice with different values, clicks moved to another dataset, sign-ups under new ids
_CHANGES = """
SELECT id, iddataset_l, datasetversion_l, origin_s, time_dt, type_s, value_d + 1 AS value_d, note_s FROM {x_doc} WHERE type_s = 'purchase'
UNION ALL
SELECT id, iddataset_l, datasetversion_l, origin_s, time_dt, type_s, value_d + 2, note_s FROM {x_doc} WHERE type_s = 'purchase'
UNION ALL
SELECT id, CAST(7 AS bigint), datasetversion_l, origin_s, time_dt, type_s, value_d, note_s FROM {x_doc} WHERE type_s = 'click'
UNION ALL
SELECT concat('f', substring(id, 2)), iddataset_l, datasetversion_l, origin_s, time_dt, type_s, value_d, note_s FROM {x_doc} WHERE type_s = 'signup'
"""
_DOC = "id, iddataset_l, datasetversion_l, origin_s, CAST(time_dt AS string) AS time_dt, type_s, value_d, note_s"


@query(
    "serving_upsert",
    f"""WITH changes AS ({_CHANGES}), newest AS (
          SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY value_d DESC) AS n FROM changes) r WHERE n = 1)
        SELECT {_DOC} FROM newest UNION ALL SELECT {_DOC} FROM {{x_doc}} WHERE id NOT IN (SELECT id FROM newest)""",
)
def serving_upsert(t: Inputs) -> DataFrame:
    path = _collection(t, t("x_doc"))
    store.merge_documents(t.spark, path, t.sql(_CHANGES), newest_first=[F.desc("value_d")])
    return plain_types(read_collection(t.spark, path))


@query("serving_delete", f"SELECT {_DOC} FROM {{x_doc}} WHERE NOT (iddataset_l = 3 AND origin_s = 'datalake')")
def serving_delete(t: Inputs) -> DataFrame:
    path = _collection(t, t("x_doc"))
    store.delete_documents(t.spark, path, 3)
    return plain_types(read_collection(t.spark, path))


@query(
    "serving_count",
    """SELECT iddataset_l, datasetversion_l, count(*) AS documents FROM {x_serving} GROUP BY iddataset_l, datasetversion_l""",
)
def serving_count(t: Inputs) -> DataFrame:
    return count_by_version(t("x_serving"))


# ---------------------------------------------------------------- publish and promote


def _published(t: Inputs) -> DataFrame:
    rows = scan_dataset(t("x_lake"), LAKE_FIELDS, 42, 3, "measures")
    return publish.serving_documents(rows.withColumn("iddataset_l", F.col("counter_l")))


_PUBLISHED = """
SELECT bda_id AS id, Counter AS iddataset_l, CAST(3 AS bigint) AS datasetversion_l, bda_origin AS origin_s,
  CAST(CAST(bda_time AS date) AS string) AS time_dt, bda_sensor AS sensor_s, bda_streamcode AS streamcode_s, Kind AS kind_s,
  reading AS reading_d, Counter AS counter_l, CAST(CAST(Seen AS date) AS string) AS seen_dt,
  CAST(CAST(level AS real) AS double) AS level_f, note AS note_s FROM {x_lake}
"""
# what the collection held before: lake documents to be replaced, others to be kept
_EARLIER = """
SELECT concat('e', substring(id, 2)) AS id, iddataset_l, CAST(datasetversion_l + 1 AS bigint) AS datasetversion_l, origin_s, type_s AS kind_s
FROM {x_serving}
"""


def _publish(t: Inputs) -> tuple[str, DataFrame]:
    path = _collection(t, t.sql(_EARLIER))
    return path, publish.publish(t.spark, path, _published(t), "overwrite")


@query(
    "publish_dataset",
    f"""SELECT id, iddataset_l, datasetversion_l, origin_s, kind_s, time_dt, seen_dt, reading_d, level_f, note_s, sensor_s, streamcode_s, counter_l
        FROM ({_PUBLISHED}) p
        UNION ALL SELECT id, iddataset_l, datasetversion_l, origin_s, kind_s, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
        FROM ({_EARLIER}) e WHERE origin_s <> 'datalake'""",
)
def publish_dataset(t: Inputs) -> DataFrame:
    path, _ = _publish(t)
    return plain_types(read_collection(t.spark, path)).select(
        "id", "iddataset_l", "datasetversion_l", "origin_s", "kind_s", "time_dt", "seen_dt", "reading_d", "level_f", "note_s",
        "sensor_s", "streamcode_s", "counter_l",
    )


@query(
    "publish_reconcile",
    f"""SELECT p.iddataset_l, p.datasetversion_l, record_read, coalesce(record_before, 0) AS record_before,
          record_read + coalesce(kept, 0) AS record_after, record_read AS record_write
        FROM (SELECT iddataset_l, datasetversion_l, count(*) AS record_read FROM ({_PUBLISHED}) x GROUP BY 1, 2) p
        LEFT JOIN (SELECT iddataset_l, datasetversion_l, count(*) AS record_before,
              count(*) FILTER (WHERE origin_s <> 'datalake') AS kept FROM ({_EARLIER}) y GROUP BY 1, 2) e
          ON e.iddataset_l = p.iddataset_l AND e.datasetversion_l = p.datasetversion_l""",
)
def publish_reconcile(t: Inputs) -> DataFrame:
    return _publish(t)[1]


@query(
    "publish_blocks",
    "SELECT CAST(floor(sparkuniqueid / 1000) AS bigint) AS block, count(*) AS rows FROM {x_lake} GROUP BY 1",
)
def publish_blocks(t: Inputs) -> DataFrame:
    return publish.row_blocks(t("x_lake"), 1000)


@query(
    "promote_dataset",
    """SELECT o_orderkey, o_totalprice, bda_sensor, lpad(printf('%x', 1538352000), 8, '0') || lpad(printf('%x', 42 * 1099511627776 + n), 16, '0') AS bda_id,
         'datalake' AS bda_origin, n AS sparkuniqueid
       FROM (SELECT *, row_number() OVER (ORDER BY rowkey) AS n FROM {x_row}) r""",
)
def promote_dataset(t: Inputs) -> DataFrame:
    """A first load of some rows, then the whole table in its place, read back from the lake table."""
    rows, table, root = t("x_row"), f"promoted_{uuid.uuid4().hex}", scratch_path(t.spark, "lake")
    for source, load_time in ((rows.where("o_orderkey % 2 = 0"), "2018-09-30 00:00:00"), (rows, "2018-10-01 00:00:00")):
        promote.promote(source, ["o_orderkey", "o_totalprice", "bda_sensor"], table, load_time, root, order_by=["o_orderkey"], id_space=42)
    return t.spark.table(table)


# ---------------------------------------------------------------- CSV exports

# one folder and code per dataset version, derived from the documents
_FOLDERS = """
SELECT DISTINCT iddataset_l AS iddataset, datasetversion_l AS datasetversion,
  concat('ds_', CAST(iddataset_l AS string)) AS datasetcode FROM {%s}
"""


def _descriptors(t: Inputs, docs: str, root: str) -> DataFrame:
    return t.sql(_FOLDERS % docs).withColumn("folder", F.concat_ws("/", F.lit(root), "datasetcode"))


def _raw_rows(t: Inputs, root: str, columns: list[str]) -> DataFrame:
    """Every row of the published files with what the file name says; a run that had nothing to export published none."""
    Files(t.spark).make_folder(root)
    rows = read_raw_csv(t.spark, root, columns, multi_line=True, recursive=True)
    named = name_parts(rows.withColumn("path", F.col("_metadata.file_path")))
    return named.select(*columns, "oid", "file_rows", "datasetcode", "datasetversion")


_CSV_COLUMNS = ["time", "type", "value", "note"]
_CSV = """strftime(time_dt, '%Y-%m-%dT%H:%M:%S.%gZ') AS time, type_s AS type, CAST(value_d AS string) AS value, coalesce(note_s, '') AS note,
  concat('ds_', CAST(iddataset_l AS string)) AS datasetcode, CAST(datasetversion_l AS int) AS datasetversion"""


@query(
    "csv_export_roundtrip",
    f"""SELECT {_CSV}, repeat('6', 24) AS oid, count(*) OVER (PARTITION BY iddataset_l, datasetversion_l) AS file_rows FROM {{x_doc}}""",
)
def csv_export_roundtrip(t: Inputs) -> DataFrame:
    root = scratch_path(t.spark, "datalake")
    alignment = state.state_table(t.spark, scratch_path(t.spark, "state"))
    descriptors = _descriptors(t, "x_doc", root)
    for run in ("5" * 24, "6" * 24):
        export.full_export(t.spark, t("x_doc"), descriptors, alignment, "overwrite", run)
    return _raw_rows(t, root, _CSV_COLUMNS)


UPPER = "65a7c9dc0000000000000000"  # 2024-01-17 12:36:44 UTC, the upper id of the run
_PENDING = f"""
SELECT s.* FROM {{x_serving}} s LEFT JOIN {{x_state}} a ON a.iddataset = iddataset_l AND a.datasetversion = datasetversion_l
WHERE id > coalesce(last_id, repeat('0', 24)) AND id <= '{UPPER}'
"""
DUCK_VIEWS["o_pending"] = _PENDING


@query(
    "incremental_count_max",
    """SELECT iddataset_l AS iddataset, datasetversion_l AS datasetversion, count(*) AS documents, max(id) AS last_id
       FROM {o_pending} GROUP BY iddataset_l, datasetversion_l""",
)
def incremental_count_max(t: Inputs) -> DataFrame:
    datasets = t.sql(_FOLDERS % "x_serving")
    return incremental.next_state(incremental.pending_documents(t("x_serving"), datasets, t("x_state"), UPPER))


def _run_incremental(t: Inputs) -> tuple[str, state.StateTable]:
    root = scratch_path(t.spark, "datalake")
    alignment = state.state_table(t.spark, scratch_path(t.spark, "state"))
    alignment.write(t("x_state"))
    docs = snapshot(t.spark, _collection(t, t("x_serving")))
    incremental.run_incremental_export(t.spark, docs, _descriptors(t, "x_serving", root), alignment, UPPER)
    return root, alignment


@query(
    "incremental_export",
    f"""SELECT {_CSV}, '{UPPER}' AS oid, count(*) OVER (PARTITION BY iddataset_l, datasetversion_l) AS file_rows FROM {{o_pending}}""",
)
def incremental_export(t: Inputs) -> DataFrame:
    root, _ = _run_incremental(t)
    return _raw_rows(t, root, _CSV_COLUMNS)


_MERGED = """
SELECT coalesce(n.iddataset, a.iddataset) AS iddataset, coalesce(n.datasetversion, a.datasetversion) AS datasetversion,
  coalesce(n.last_id, a.last_id) AS last_id FROM {x_state} a
FULL JOIN (SELECT iddataset_l AS iddataset, datasetversion_l AS datasetversion, max(id) AS last_id FROM {%s} GROUP BY 1, 2) n
  ON n.iddataset = a.iddataset AND n.datasetversion = a.datasetversion
"""


@query("incremental_state", _MERGED % "o_pending")
def incremental_state(t: Inputs) -> DataFrame:
    return _run_incremental(t)[1].read()


@query(
    "incremental_stream",
    f"SELECT {_CSV} FROM {{o_pending}}",
)
def incremental_stream(t: Inputs) -> DataFrame:
    source = _collection(t, t("x_serving"))
    root, checkpoint = scratch_path(t.spark, "datalake"), scratch_path(t.spark, "checkpoint")
    alignment = state.state_table(t.spark, scratch_path(t.spark, "state"))
    alignment.write(t("x_state"))
    docs = stream_collection(t.spark, source)
    held = scratch_path(t.spark, "held")
    start_incremental_export(docs, _descriptors(t, "x_serving", root), alignment, held, UPPER, checkpoint).awaitTermination()
    return _raw_rows(t, root, _CSV_COLUMNS).select(*_CSV_COLUMNS, "datasetcode", "datasetversion")


@query(
    "watermark_lookup",
    """SELECT DISTINCT iddataset_l AS iddataset, datasetversion_l AS datasetversion, coalesce(last_id, repeat('0', 24)) AS last_id
       FROM {x_serving} LEFT JOIN {x_state} a ON a.iddataset = iddataset_l AND a.datasetversion = datasetversion_l""",
)
def watermark_lookup(t: Inputs) -> DataFrame:
    datasets = t.sql(_FOLDERS % "x_serving").select(*state.STATE_KEYS)
    return state.last_ids(datasets, t("x_state"))


@query(
    "watermark_upsert",
    """SELECT coalesce(n.iddataset, a.iddataset) AS iddataset, coalesce(n.datasetversion, a.datasetversion) AS datasetversion,
         CASE WHEN n.iddataset IS NULL THEN a.last_id ELSE 'f48648f00000000000000000' END AS last_id
       FROM {x_state} a FULL JOIN (SELECT DISTINCT iddataset_l AS iddataset, datasetversion_l AS datasetversion FROM {x_doc}) n
         ON n.iddataset = a.iddataset AND n.datasetversion = a.datasetversion""",
)
def watermark_upsert(t: Inputs) -> DataFrame:
    alignment = state.state_table(t.spark, scratch_path(t.spark, "state"))
    alignment.write(t("x_state"))
    alignment.write(state.merge_state(alignment.read(), state.stop_incremental(t.sql(_FOLDERS % "x_doc"))))
    return alignment.read()


@query(
    "job_stats",
    """SELECT 'publish' AS job, concat('lake.t', CAST(iddataset_l AS string)) AS source, 'serving' AS destination,
         count(*) AS record_read, count(*) AS record_write, concat('ds_', CAST(iddataset_l AS string)) AS dataset_code
       FROM {x_doc} GROUP BY iddataset_l""",
)
def job_stats(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "stats")
    number = F.col("iddataset_l").cast("string")
    counts = t("x_doc").groupBy("iddataset_l").agg(F.count("*").alias("record_read")).select(
        F.concat(F.lit("lake.t"), number).alias("source"), F.lit("serving").alias("destination"), "record_read",
        F.col("record_read").alias("record_write"), F.concat(F.lit("ds_"), number).alias("dataset_code"),
    )
    append_stats(stats_rows(counts, "publish", "nightly", "coordinator"), path)
    return t.spark.read.orc(path).select("job", "source", "destination", "record_read", "record_write", "dataset_code")


# ---------------------------------------------------------------- raw files

_RAW_COLUMNS = ["time", "sensor", "streamcode", "price"]


def _raw_order_rows(t: Inputs) -> tuple[DataFrame, DataFrame]:
    """Orders as stream rows, some times missing: those that arrive in time, and late ones of the same months."""
    month = F.date_trunc("month", "bda_time")
    rows = t("x_row").select(
        F.when(F.col("bda_sensor") != "5-LOW", F.date_format("bda_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("time"),
        F.col("bda_sensor").alias("sensor"), F.col("bda_streamcode").alias("streamcode"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.lit("orders").alias("code"), month.alias("month"), ((F.col("bda_sensor") >= "3") & (F.col("o_orderkey") % 3 == 0)).alias("late"),
        id_from_time(month, (F.col("bda_sensor") < "3").cast("int") + 1).alias("oid"),
    )
    months = rows.where("NOT late").select("month").distinct().withColumn("open", F.lit(True))
    rows = rows.join(months, "month", "left").withColumn("late", F.col("late") & F.col("open").isNotNull())
    return rows.where("NOT late"), rows.where("late").withColumn("oid", id_from_time(F.col("month"), F.lit(0)))


def _write_raw_files(t: Inputs, root: str, rows: DataFrame, empty: bool) -> None:
    """Small stream files: up to two per month, and one with nothing in it if asked. Every file holds a repeated header."""
    files = rows.groupBy("code", "oid").agg(F.count("*").alias("rows"))
    if empty:
        files = files.unionByName(files.select("code", F.concat(F.substring("oid", 1, 8), F.lit("0" * 16)).alias("oid"), F.lit(0).cast("bigint").alias("rows")).distinct())
    headers = files.select(*[F.lit(c).alias(c) for c in _RAW_COLUMNS], "code", "oid")
    stage = scratch_path(t.spark, "raw")
    csv_writer(rows.select(*headers.columns).unionByName(headers).repartition("code", "oid")).partitionBy("code", "oid").csv(stage)
    stored = file_sizes(t.spark, stage, "*.csv").select(
        "path", F.regexp_extract("path", "/code=([^/]+)/", 1).alias("code"), F.regexp_extract("path", "/oid=([^/]+)/", 1).alias("oid")
    ).join(files, ["code", "oid"])
    name = export_file_name(F.col("oid"), F.col("rows"), F.concat(F.lit("ds-"), F.col("code")), F.lit(1))
    disk = Files(t.spark)
    for row in stored.select("path", F.concat_ws("/", F.lit(root), "code", name).alias("target")).toLocalIterator():
        disk.rename(row["path"], row["target"])


@query(
    "csv_compaction",
    """SELECT CASE bda_sensor WHEN '5-LOW' THEN NULL ELSE strftime(bda_time, '%Y-%m-%dT%H:%M:%S.%gZ') END AS time,
         bda_sensor AS sensor, bda_streamcode AS streamcode, CAST(o_totalprice AS string) AS price,
         'ds-orders' AS datasetcode, 1 AS datasetversion,
         lpad(printf('%x', CAST(epoch(date_trunc('month', bda_time)) AS bigint)), 8, '0') ||
           lpad(CAST(max(CASE WHEN bda_sensor < '3' THEN 2 ELSE 1 END) OVER (PARTITION BY date_trunc('month', bda_time)) AS string), 16, '0') AS oid,
         count(*) OVER (PARTITION BY date_trunc('month', bda_time)) AS file_rows
       FROM {x_row}""",
)
def csv_compaction(t: Inputs) -> DataFrame:
    """Two runs; in between more rows arrive for months that have been compacted."""
    root, archive = scratch_path(t.spark, "datalake"), scratch_path(t.spark, "archive")
    for rows, empty in zip(_raw_order_rows(t), (True, False), strict=True):
        _write_raw_files(t, root, rows, empty)
        compaction.compact(t.spark, root, archive, _RAW_COLUMNS)
    return _raw_rows(t, root, _RAW_COLUMNS)


@query("space_listing", "SELECT concat('type_s=', type_s) AS folder, sum(length(id) + 1) AS byte FROM {x_doc} GROUP BY type_s")
def space_listing(t: Inputs) -> DataFrame:
    """Ids as text files, whose sizes are known: a line feed after each."""
    root = scratch_path(t.spark, "space")
    t("x_doc").select("id", "type_s").hint("rebalance", "type_s").write.partitionBy("type_s").text(root)
    return folder_sizes(file_sizes(t.spark, root), root).where("files > 0").select("folder", "byte")


# ---------------------------------------------------------------- access logs

_LOG_SOURCE = {
    "odata": "apicode forwardedfor jwt nrecin nrecout forwardedfor error_bsn tenant log_timestamp path query elapsed error_bsn error_servlet nrecin nrecout elapsed",
    "amq": "log_timestamp uniqueid nrecin query tenant tenant path query forwardedfor apicode nrecout elapsed error_bsn",
    "esb": "log_timestamp uniqueid nrecin query tenant path query forwardedfor apicode nrecout elapsed error_bsn",
    "intapi": "log_timestamp uniqueid forwardedfor jwt path apicode datasetcode tenant query nrecin nrecout elapsed error_bsn error_servlet",
}
_UNIX = "CASE WHEN log_timestamp <> '-' THEN CAST(floor(epoch(CAST(replace(log_timestamp, 'T', ' ') AS timestamp))) AS bigint) END"
_DAY_SQL = ", ".join(
    f"CASE WHEN log_timestamp <> '-' THEN CAST({part}(CAST(replace(log_timestamp, 'T', ' ') AS timestamp)) AS int) END AS {part}"
    for part in ("year", "month", "day")
)


def _feed(t: Inputs, layout: str) -> str:
    """The log rows as header-less CSV files of a layout."""
    path = scratch_path(t.spark, "feed")
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(_LOG_SOURCE[layout].split())]
    t("x_log").select(*columns).write.option("header", False).csv(path)
    return path


def _log_oracle(layout: str) -> str:
    names = zip(_LOG_SOURCE[layout].split(), logs.LAYOUTS[layout])
    return f"SELECT {', '.join(f'{a} AS {b}' for a, b in names)}, {_UNIX} AS unix_ts, {_DAY_SQL} FROM {{x_log}}"


def _register_feed(layout: str) -> None:
    @query(f"log_ingest_{layout}", _log_oracle(layout))
    def log_ingest(t: Inputs) -> DataFrame:
        return logs.read_feed(t.spark, _feed(t, layout), layout)


for _layout in logs.LAYOUTS:
    _register_feed(_layout)


@query("log_ingest_partitioned", _log_oracle("esb"))
def log_ingest_partitioned(t: Inputs) -> DataFrame:
    """Two deliveries of a feed, each consumed by a run of its own, and a third run that finds nothing."""
    root, target = scratch_path(t.spark, "feeds"), scratch_path(t.spark, "logs")
    second = F.pmod(F.xxhash64("uniqueid", "path"), F.lit(3)) == 0
    for delivery in (~second, second, None):
        if delivery is not None:
            columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(_LOG_SOURCE["esb"].split())]
            t("x_log").where(delivery).select(*columns).write.mode("append").option("header", False).csv(logs.feed_folder(root, "esbin1"))
        failed = logs.ingest_feeds(t.spark, root, target, {"esbin1": "esb"})
        if failed:
            raise RuntimeError(str(failed))
    return t.spark.read.orc(f"{target}/esbin1_partday").drop(logs.BATCH)


@query("log_ingest_stream", _log_oracle("amq"))
def log_ingest_stream(t: Inputs) -> DataFrame:
    target, checkpoint = scratch_path(t.spark, "logs"), scratch_path(t.spark, "checkpoint")
    start_log_ingest(log_stream(t.spark, _feed(t, "amq"), "amq"), target, checkpoint).awaitTermination()
    return t.spark.read.orc(target)


@query(
    "odata_call_pairs",
    f"""SELECT 'odataintapi1' AS servercode, b.log_timestamp, b.uniqueid, a.forwardedfor, a.jwt, b.path, b.apicode,
          CASE WHEN b.datasetcode IN ('-', '|') THEN d.datasetcode ELSE b.datasetcode END AS datasetcode,
          CASE WHEN b.tenant IN ('-', '|') THEN d.tenantcode ELSE b.tenant END AS tenant, a.query, b.nrecin, b.nrecout, a.elapsed,
          a.error_bsn AS e1_bsn, a.error_servlet AS e1_servlet, b.error_bsn AS e2_bsn, b.error_servlet AS e2_servlet,
          {_UNIX.replace('log_timestamp', 'b.log_timestamp')} AS unix_ts,
          {_DAY_SQL.replace('log_timestamp', 'b.log_timestamp')}
        FROM {{x_log}} a JOIN {{x_log}} b ON b.uniqueid = a.uniqueid JOIN {{x_dataset}} d ON d.datasetcode = b.apicode
        WHERE a.forwardedfor <> '-' AND b.forwardedfor = '-'""",
)
def odata_call_pairs(t: Inputs) -> DataFrame:
    columns = [F.col(a).alias(b) for a, b in zip(_LOG_SOURCE["intapi"].split(), logs.LAYOUTS["intapi"])]
    rows = logs.with_day(t("x_log").select(*columns))
    target = scratch_path(t.spark, "pairs")
    append_by_day(logs.call_pairs(rows, t("x_dataset")), target)
    return t.spark.read.orc(target)
