"""Scans, projections, joins, aggregates, selectors: the relational operators on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness.registry import plain_types, query
from harness.views import Inputs
from tidemark.functions import objectid, paths, text
from tidemark.functions.fieldtypes import apply_suffix_schema, cast_by_suffix, csv_text_columns
from tidemark.operators.joins import join_ignoring_case, join_on_code_suffix, left_join_many
from tidemark.operators.latest import latest_versions
from tidemark.operators.lists import comma_list, pivot_params
from tidemark.operators.rowid import with_dense_row_id
from tidemark.operators.sampling import sample_keys
from tidemark.plans import catalog, descriptors, selectors
from tidemark.sources.documents import document_descriptors
from tidemark.sources.listing import name_parts
from tidemark.sources.tables import scan_dataset

LAKE_FIELDS = [
    ("Kind", "string"), ("reading", "double"), ("Counter", "long"), ("Seen", "dateTime"), ("level", "float"),
    ("note", "string"), ("bda_id", "string"), ("sparkuniqueid", "long"),
]


@query(
    "scan_dataset_projection",
    """SELECT sparkuniqueid, bda_id AS id, CAST(42 AS bigint) AS iddataset_l, CAST(3 AS bigint) AS datasetversion_l,
       bda_origin AS origin_s, CAST(bda_time AS string) AS time_dt, bda_sensor AS sensor_s,
       bda_streamcode AS streamcode_s, Kind AS kind_s, reading AS reading_d, Counter AS counter_l,
       CAST(Seen AS string) AS seen_dt, level AS level_f, note AS note_s FROM {x_lake}""",
)
def scan_dataset_projection(t: Inputs) -> DataFrame:
    return plain_types(scan_dataset(t("x_lake"), LAKE_FIELDS, 42, 3, "measures"))


_TEXT_LINES = """
SELECT CAST(l_orderkey AS string) AS order_l, CASE l_linestatus WHEN 'F' THEN CAST(l_linenumber AS string) ELSE 'x' END AS line_i,
  CAST(l_quantity AS string) AS qty_d, CAST(l_extendedprice AS string) AS price_f,
  CASE l_returnflag WHEN 'R' THEN 'true' WHEN 'A' THEN 'false' ELSE 'maybe' END AS late_b,
  CASE l_returnflag WHEN 'N' THEN '-' ELSE CAST(l_shipdate AS string) END AS ship_dt, l_returnflag AS flag_s,
  l_linestatus AS status
FROM {lineitem}
"""
_TYPED_LINES = f"""
SELECT TRY_CAST(order_l AS bigint) AS order_l, TRY_CAST(line_i AS int) AS line_i, TRY_CAST(qty_d AS double) AS qty_d,
  CAST(TRY_CAST(price_f AS real) AS double) AS price_f, CASE late_b WHEN 'maybe' THEN NULL ELSE late_b = 'true' END AS late_b,
  %s AS ship_dt, flag_s, status FROM ({_TEXT_LINES}) r
"""


@query("suffix_cast", _TYPED_LINES % "CAST(CAST(TRY_CAST(ship_dt AS timestamp) AS date) AS string)")
def suffix_cast(t: Inputs) -> DataFrame:
    return plain_types(cast_by_suffix(t.sql(_TEXT_LINES)))


@query("suffix_schema_apply", _TYPED_LINES % "CAST(TRY_CAST(ship_dt AS timestamp) AS string)")
def suffix_schema_apply(t: Inputs) -> DataFrame:
    return plain_types(apply_suffix_schema(t.sql(_TEXT_LINES)))


@query(
    "csv_format_columns",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS time_dt,
       CASE event_type WHEN 'error' THEN '' ELSE event_type END AS type_s,
       CAST(CAST(value AS real) AS string) AS value_f FROM {events}""",
)
def csv_format_columns(t: Inputs) -> DataFrame:
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return csv_text_columns(
        t("events").select("event_id", F.col("ts").alias("time_dt"), kind.alias("type_s"), F.col("value").alias("value_f"))
    )


@query(
    "decimal_comma",
    "SELECT l_orderkey, l_linenumber, replace(CAST(l_discount AS string), '.', ',') AS discount FROM {lineitem}",
)
def decimal_comma(t: Inputs) -> DataFrame:
    return t("lineitem").select("l_orderkey", "l_linenumber", text.decimal_comma(F.col("l_discount")).alias("discount"))


@query(
    "clean_text",
    "SELECT doc_id, regexp_replace(text, '\\n', ' ', 'g') AS text FROM {documents}",
)
def clean_text(t: Inputs) -> DataFrame:
    return t("documents").select("doc_id", text.one_line(F.col("text")).alias("text"))


@query(
    "path_parse",
    """SELECT regexp_extract(line, '^(\\S*)\\s+(.*)$', 1) AS byte, regexp_extract(line, '^(\\S*)\\s+(.*)$', 2) AS stg_path,
       CASE WHEN regexp_matches(line, 'STAGE/[^/]+/') THEN split_part(split_part(line, 'STAGE/', 2), '/', 1) ELSE '' END
       AS tenantcode FROM {x_stage}""",
)
def path_parse(t: Inputs) -> DataFrame:
    line = F.col("line")
    path = text.listing_path(line)
    return t("x_stage").select(
        text.listing_bytes(line).alias("byte"), path.alias("stg_path"), text.stage_tenant(path).alias("tenantcode")
    )


@query(
    "sample_scan",
    """SELECT event_id, user_id, value FROM {events}
       WHERE CAST(concat('0x', substring(md5(concat('7:', CAST(event_id AS string))), 1, 8)) AS bigint) < 429496729""",
)
def sample_scan(t: Inputs) -> DataFrame:
    return sample_keys(t("events").select("event_id", "user_id", "value"), "event_id", 0.1, 7)


@query(
    "objectid_time",
    """SELECT id, CAST(floor(epoch(time_dt)) AS bigint) AS seconds, CAST(year(time_dt) AS int) AS year,
       CAST(month(time_dt) AS int) AS month FROM {x_serving}""",
)
def objectid_time(t: Inputs) -> DataFrame:
    oid = F.col("id")
    return t("x_serving").select(
        "id", objectid.id_seconds(oid).alias("seconds"), objectid.id_year(oid).alias("year"), objectid.id_month(oid).alias("month")
    )


@query(
    "objectid_make",
    """SELECT event_id, lpad(printf('%x', CAST(floor(epoch(ts)) AS bigint)), 8, '0') || lpad(printf('%x', event_id), 16, '0') AS oid,
       lpad(printf('%x', CAST(floor(epoch(ts)) AS bigint) - 420), 8, '0') || repeat('0', 16) AS upper_oid FROM {events}""",
)
def objectid_make(t: Inputs) -> DataFrame:
    ts = F.col("ts")
    return t("events").select(
        "event_id", objectid.id_from_time(ts, F.col("event_id")).alias("oid"), objectid.upper_bound_id(ts).alias("upper_oid")
    )


_CHOICE_WITH_STREAM = """
SELECT c.*, s.streamcode, s.slug FROM {x_choice} c
LEFT JOIN {x_dataset_stream} s ON s.iddataset = c.iddataset AND s.datasetversion = c.datasetversion
"""
_PATH_COLUMNS = """
CASE sottotipo WHEN 'bulkDataset' THEN 'data' WHEN 'socialDataset' THEN 'social' ELSE 'measures' END AS family,
CASE WHEN codsubdomain = '' THEN datadomain ELSE codsubdomain END AS codsubdomain,
regexp_replace(slug, '[^a-zA-Z0-9_-]', '-', 'g') AS slug,
concat('/datalake/', upper(organizationcode), '/rawdata/', upper(datadomain), '/',
  CASE sottotipo WHEN 'bulkDataset'
    THEN concat('db_', upper(CASE WHEN codsubdomain = '' THEN datadomain ELSE codsubdomain END), '/', datasetcode)
    ELSE concat('so_', coalesce(regexp_replace(slug, '[^a-zA-Z0-9_-]', '-', 'g'), ''), '/', streamcode) END) AS folder
"""


@query(
    "dataset_paths",
    f"""SELECT iddataset, datasetversion, {_PATH_COLUMNS}, concat(CASE sottotipo WHEN 'bulkDataset' THEN 'data_'
          WHEN 'socialDataset' THEN 'social_' ELSE 'measures_' END, organizationcode) AS collection FROM ({_CHOICE_WITH_STREAM}) r""",
)
def dataset_paths(t: Inputs) -> DataFrame:
    full = descriptors.with_paths(t.sql(_CHOICE_WITH_STREAM))
    own = [F.concat(F.lit(f"{kind}_"), "organizationcode") for kind in ("data", "measures", "social", "media")]
    collection = paths.default_collection(F.col("family"), *own).alias("collection")
    return full.select("iddataset", "datasetversion", "family", "codsubdomain", "slug", "folder", collection)


@query(
    "export_file_name",
    """SELECT iddataset, datasetversion,
       concat(repeat('5', 24), '_', CAST(numrecord AS string), '-ds_', CAST(iddataset AS string), '-', CAST(datasetversion AS string), '.csv')
       AS file_name, printf('_%05d-%03d.csv.tmp', iddataset, datasetversion) AS work_name FROM {x_serving_dim}""",
)
def export_file_name(t: Inputs) -> DataFrame:
    code = F.concat(F.lit("ds_"), F.col("iddataset").cast("string"))
    name = paths.export_file_name(F.lit("5" * 24), F.col("numrecord"), code, F.col("datasetversion"))
    work = paths.work_name(F.col("iddataset"), F.col("datasetversion"))
    return t("x_serving_dim").select("iddataset", "datasetversion", name.alias("file_name"), work.alias("work_name"))


@query(
    "dataset_descriptor",
    f"""WITH fields AS (
      SELECT iddataset, datasetversion, string_agg(concat(lower(name), CASE datatype WHEN 'string' THEN '_s' WHEN 'double' THEN '_d'
        WHEN 'dateTime' THEN '_dt' WHEN 'int' THEN '_i' ELSE '_f' END), ',' ORDER BY position) AS columns
      FROM {{x_component}} GROUP BY iddataset, datasetversion),
    streams AS (
      SELECT c.*, CASE WHEN c.sottotipo IN ('streamDataset', 'socialDataset') THEN s.streamcode END AS streamcode,
        CASE WHEN c.sottotipo IN ('streamDataset', 'socialDataset') THEN s.slug END AS slug
      FROM {{x_choice}} c
      LEFT JOIN {{x_dataset_stream}} s ON s.iddataset = c.iddataset AND s.datasetversion = c.datasetversion)
    SELECT r.iddataset, r.datasetversion, datasetcode, tenantcode, organizationcode, columns, r.streamcode,
      family, codsubdomain, slug, folder
    FROM (SELECT iddataset, datasetversion, datasetcode, tenantcode, organizationcode, streamcode,
            {_PATH_COLUMNS.replace("'/', streamcode)", "coalesce('/' || streamcode, ''))")} FROM streams) r
    LEFT JOIN fields f ON f.iddataset = r.iddataset AND f.datasetversion = r.datasetversion""",
)
def dataset_descriptor(t: Inputs) -> DataFrame:
    full = descriptors.descriptors(t("x_choice"), t("x_component"), t("x_dataset_stream"))
    return full.select(
        "iddataset", "datasetversion", "datasetcode", "tenantcode", "organizationcode",
        descriptors.serving_names().alias("columns"), "streamcode", "family", "codsubdomain", "slug", "folder",
    )


_CHOICE = "iddataset, datasetversion, tenantcode"


@query(
    "dataset_select_tenant",
    f"SELECT {_CHOICE} FROM {{x_choice}} WHERE availablespeed AND sottotipo <> 'binaryDataset' AND datasetstatus_desc = 'installed'",
)
def dataset_select_tenant(t: Inputs) -> DataFrame:
    return selectors.by_tenant(t("x_choice"), t("x_tenant")).select(*_CHOICE.split(", "))


@query(
    "dataset_select_id",
    f"""SELECT {_CHOICE}, availablespeed AND sottotipo <> 'binaryDataset' AND datasetstatus_desc = 'installed' AS eligible
        FROM {{x_choice}}""",
)
def dataset_select_id(t: Inputs) -> DataFrame:
    return selectors.by_id(t("x_choice"), t("x_component")).select(*_CHOICE.split(", "), "eligible")


@query(
    "dataset_select_group",
    """SELECT idgroup, groupversion, c.iddataset, datasetversion FROM {x_member} m JOIN {x_choice} c ON c.iddataset = m.iddataset
       WHERE sottotipo <> 'binaryDataset' AND datasetstatus_desc = 'installed' AND availablespeed
         AND jdbcdburl = 'datalake' AND jdbcdbtype = 'HIVE' AND istransformed""",
)
def dataset_select_group(t: Inputs) -> DataFrame:
    chosen = selectors.by_group(t("x_choice"), t("x_member"), to_lake=True, to_serving=True)
    return chosen.select("idgroup", "groupversion", "iddataset", "datasetversion")


@query(
    "dataset_select_promotable",
    f"SELECT {_CHOICE}, jdbcdburl = 'datalake' AND jdbcdbtype = 'HIVE' AND istransformed AS eligible FROM {{x_choice}}",
)
def dataset_select_promotable(t: Inputs) -> DataFrame:
    return selectors.promotable(t("x_choice")).select(*_CHOICE.split(", "), "eligible")


@query(
    "dataset_select_docs",
    """SELECT c.iddataset AS idDataset, c.datasetversion AS datasetVersion, c.tenantcode AS tenantCode, c.sottotipo AS subType,
         CASE WHEN codsubdomain = '' THEN datadomain ELSE codsubdomain END AS codSubDomain,
         CASE WHEN c.sottotipo IN ('streamDataset', 'socialDataset') THEN s.streamcode END AS streamCode,
         CASE WHEN c.sottotipo IN ('streamDataset', 'socialDataset')
           THEN regexp_replace(s.slug, '[^a-zA-Z0-9_-]', '-', 'g') END AS vESlug
       FROM {x_choice} c
       LEFT JOIN {x_dataset_stream} s ON s.iddataset = c.iddataset AND s.datasetversion = c.datasetversion
       WHERE c.sottotipo <> 'binaryDataset' AND availablespeed AND datasetstatus_desc = 'installed' AND idstatus <> 5""",
)
def dataset_select_docs(t: Inputs) -> DataFrame:
    docs = t.sql("""
      SELECT CAST(iddataset AS int) AS idDataset, datasetversion AS datasetVersion, datasetcode AS datasetCode, availablespeed AS availableSpeed,
        named_struct('subtype', sottotipo, 'tenantCode', tenantcode,
          'current', CASE datasetstatus_desc WHEN 'installed' THEN 1 ELSE 0 END,
          'deleted', CASE WHEN idstatus = 5 THEN 1 WHEN datadomain = 'MULTI' THEN 0 END) AS configData,
        named_struct('dataDomain', datadomain, 'codSubDomain', codsubdomain,
          'fields', array(named_struct('fieldName', 'f', 'dataType', 'int'))) AS info
      FROM {x_choice}""")
    streams = t.sql("""
      SELECT s.streamcode AS streamCode, named_struct('tenantCode', d.tenantcode, 'idDataset', CAST(s.iddataset AS int),
        'datasetVersion', s.datasetversion) AS configData,
        named_struct('stream', named_struct('virtualEntitySlug', s.slug)) AS streams
      FROM {x_dataset_stream} s JOIN {x_dataset} d ON d.iddataset = s.iddataset AND d.datasetversion = s.datasetversion""")
    found = document_descriptors(docs, streams)
    return found.select(
        F.col("idDataset").cast("bigint").alias("idDataset"), "datasetVersion", "tenantCode", "subType", "codSubDomain",
        "streamCode", "vESlug",
    )


@query("dataset_select_export", f"SELECT {_CHOICE} FROM {{x_choice}} WHERE idsubtype <> 3 AND idstatus <> 5")
def dataset_select_export(t: Inputs) -> DataFrame:
    return selectors.exportable(t("x_choice")).select(*_CHOICE.split(", "))


@query(
    "dataset_select_compaction",
    f"""SELECT {_CHOICE} FROM {{x_choice}} WHERE sottotipo NOT IN ('bulkDataset', 'binaryDataset')""",
)
def dataset_select_compaction(t: Inputs) -> DataFrame:
    organizations = t("m_organization").select("organizationcode")
    return selectors.compactable(t("x_choice"), organizations=organizations).select(*_CHOICE.split(", "))


@query(
    "catalog_filter",
    """SELECT db_name, tbl_name, tbl_name LIKE 'TB_%' AS is_lake, tbl_name IN ('part_1', 'part_2') AS is_listed FROM {x_catalog}
       WHERE (db_name LIKE 'db_%' OR db_name LIKE 'transf_%') AND db_name NOT IN ('db_log') AND tbl_name NOT LIKE 'db_catalog%'""",
)
def catalog_filter(t: Inputs) -> DataFrame:
    name = F.col("tbl_name")
    kept = catalog.countable(t("x_catalog"), ["db_log"])
    return kept.select(
        "db_name", "tbl_name", catalog.name_matches(name, "TB_%").alias("is_lake"),
        catalog.name_matches(name, "part_1,part_2").alias("is_listed"),
    )


@query(
    "latest_version",
    """SELECT l.l_orderkey, l.l_linenumber, l_partkey, l_suppkey FROM {lineitem} l
       JOIN (SELECT l_orderkey, max(l_linenumber) AS l_linenumber FROM {lineitem} GROUP BY l_orderkey) m
         ON m.l_orderkey = l.l_orderkey AND m.l_linenumber = l.l_linenumber""",
)
def latest_version(t: Inputs) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return latest_versions(lines, "l_orderkey", "l_linenumber")


@query(
    "join_left",
    """SELECT t.tenantcode, tenantname, iddataset, datasetversion FROM {x_tenant} t
       LEFT JOIN {x_dataset} d ON d.tenantcode = t.tenantcode""",
)
def join_left(t: Inputs) -> DataFrame:
    tenants = t("x_tenant").select("tenantcode", "tenantname")
    return left_join_many(tenants, t("x_dataset").select("tenantcode", "iddataset", "datasetversion"), ["tenantcode"])


@query(
    "join_left_composite",
    """SELECT d.iddataset, d.datasetversion, numrecord FROM {x_dataset} d
       LEFT JOIN {x_serving_dim} s ON s.iddataset = d.iddataset AND s.datasetversion = d.datasetversion""",
)
def join_left_composite(t: Inputs) -> DataFrame:
    served = t("x_serving_dim").select("iddataset", "datasetversion", "numrecord")
    return t("x_dataset").select("iddataset", "datasetversion").join(served, ["iddataset", "datasetversion"], "left")


@query(
    "join_inner",
    """SELECT d.datasetcode, d.datasetversion, tenantname, num_bytes FROM {x_dataset} d
       JOIN {x_dim_dataset} s ON s.datasetcode = d.datasetcode AND s.datasetversion = d.datasetversion
       JOIN {x_tenant} t ON t.tenantcode = d.tenantcode""",
)
def join_inner(t: Inputs) -> DataFrame:
    sized = t("x_dataset").select("datasetcode", "datasetversion", "tenantcode").join(
        t("x_dim_dataset").select("datasetcode", "datasetversion", "num_bytes"), ["datasetcode", "datasetversion"]
    )
    named = sized.join(t("x_tenant").select("tenantcode", "tenantname"), "tenantcode")
    return named.select("datasetcode", "datasetversion", "tenantname", "num_bytes")


@query(
    "join_case_insensitive",
    """SELECT tbl_name, db_name, iddataset, datasetversion FROM {x_catalog}
       JOIN {x_dataset} ON upper(tbl_name) = upper(dbhivetable) AND upper(db_name) = upper(dbhiveschema)""",
)
def join_case_insensitive(t: Inputs) -> DataFrame:
    pairs = [("tbl_name", "dbhivetable"), ("db_name", "dbhiveschema")]
    return join_ignoring_case(t("x_catalog"), t("x_dataset"), pairs, "inner").select(
        "tbl_name", "db_name", "iddataset", "datasetversion"
    )


@query(
    "join_computed_key",
    """SELECT d.iddataset, d.datasetversion, l.line FROM {x_dataset} d
       LEFT JOIN {x_space} l ON upper(split_part(line, '/serving/', 2)) = upper(d.solrcollectionname)""",
)
def join_computed_key(t: Inputs) -> DataFrame:
    named = t("x_space").select("line", text.below(text.listing_path(F.col("line")), "/serving").alias("name"))
    datasets = t("x_dataset").select("iddataset", "datasetversion", "solrcollectionname")
    joined = join_ignoring_case(datasets, named, [("solrcollectionname", "name")], "left")
    return joined.select("iddataset", "datasetversion", "line")


@query(
    "join_suffix",
    """SELECT d.tenantcode, d.iddataset, d.datasetversion, s.datasetcode, num_rows FROM {x_dataset} d
       JOIN {x_dim_dataset} s ON s.datasetcode = concat('ds_', CAST(d.binaryiddataset AS string))
         AND s.datasetversion = d.binarydatasetversion""",
)
def join_suffix(t: Inputs) -> DataFrame:
    ids = t("x_dataset").select("tenantcode", "iddataset", "datasetversion", "binaryiddataset", "binarydatasetversion")
    coded = t("x_dim_dataset").select("datasetcode", F.col("datasetversion").alias("_version"), "num_rows")
    found = join_on_code_suffix(ids, "binaryiddataset", "binarydatasetversion", coded, "datasetcode", "_version")
    return found.select("tenantcode", "iddataset", "datasetversion", "datasetcode", "num_rows")


_LAST = """
(SELECT d.* FROM {x_dataset} d JOIN (SELECT iddataset, max(datasetversion) AS v FROM {x_dataset} GROUP BY iddataset) m
  ON m.iddataset = d.iddataset AND m.v = d.datasetversion WHERE datasetstatus = 'inst')
"""
_COUNTED = """(db_name LIKE 'db_%' OR db_name LIKE 'transf_%') AND db_name NOT IN ('db_log') AND tbl_name NOT LIKE 'db_catalog%'"""
OWNED = f"""
SELECT l.tenantcode, db_name AS dbname, tbl_name, total_size, num_rows, '0' AS flag_approx FROM {{x_catalog}}
JOIN {_LAST} l ON upper(tbl_name) = upper(dbhivetable) AND upper(db_name) = upper(dbhiveschema) WHERE {_COUNTED}
"""
UNOWNED = f"""
SELECT o.tenantcode, db_name AS dbname, tbl_name, total_size, num_rows, '1' AS flag_approx FROM {{x_catalog}}
LEFT JOIN {{x_owner}} o ON o.db_hive = db_name
WHERE {_COUNTED} AND NOT EXISTS (SELECT 1 FROM {_LAST} l WHERE upper(tbl_name) = upper(l.dbhivetable) AND upper(db_name) = upper(l.dbhiveschema))
"""


@query("catalog_owned", OWNED)
def catalog_owned(t: Inputs) -> DataFrame:
    return catalog.owned_tables(t("x_catalog"), t("x_dataset"), ["db_log"])


@query("catalog_unowned", UNOWNED)
def catalog_unowned(t: Inputs) -> DataFrame:
    return catalog.unowned_tables(t("x_catalog"), t("x_dataset"), t("x_owner"), ["db_log"])


@query(
    "catalog_sizes",
    """SELECT name AS db_name, tbl_name, strftime(to_timestamp(create_time) AT TIME ZONE 'UTC', '%Y-%m-%d %H.%M.%S') AS creation_date,
         location AS tb_location, num_rows, total_size
       FROM {x_database} d JOIN {x_table} t ON t.db_id = d.db_id LEFT JOIN {x_storage} s ON s.sd_id = t.sd_id
       JOIN (SELECT tbl_id, max(CASE param_key WHEN 'numRows' THEN param_value END) AS num_rows,
               max(CASE param_key WHEN 'totalSize' THEN param_value END) AS total_size
             FROM {x_param} WHERE param_key IN ('numRows', 'transient_lastDdlTime', 'totalSize') GROUP BY tbl_id) p
         ON p.tbl_id = t.tbl_id
       WHERE (name LIKE 'db_%' OR name LIKE 'transf_%') AND tbl_type <> 'EXTERNAL_TABLE'""",
)
def catalog_sizes(t: Inputs) -> DataFrame:
    return catalog.catalog_sizes(t("x_database"), t("x_table"), t("x_storage"), t("x_param"))


@query(
    "params_pivot",
    """SELECT tbl_id, max(CASE param_key WHEN 'numRows' THEN param_value END) AS "numRows",
         max(CASE param_key WHEN 'totalSize' THEN param_value END) AS "totalSize"
       FROM {x_param} WHERE param_key IN ('numRows', 'totalSize') GROUP BY tbl_id""",
)
def params_pivot(t: Inputs) -> DataFrame:
    return pivot_params(t("x_param"), "tbl_id", "param_key", "param_value", ["numRows", "totalSize"])


@query(
    "list_agg",
    """SELECT id_data_source, datasourceversion, string_agg(DISTINCT name, ',' ORDER BY name) AS names
       FROM {m_component} GROUP BY id_data_source, datasourceversion""",
)
def list_agg(t: Inputs) -> DataFrame:
    return comma_list(t("m_component"), ["id_data_source", "datasourceversion"], "name", "names")


@query(
    "dense_row_id",
    """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS sparkuniqueid FROM {orders}""",
)
def dense_row_id(t: Inputs) -> DataFrame:
    rows = t("orders").select("o_orderkey", "o_totalprice")
    return with_dense_row_id(rows, order_by=[F.desc("o_totalprice"), F.asc("o_orderkey")])


@query(
    "compaction_file_groups",
    """SELECT concat('/datalake/ORG/rawdata/D/so_x/', CAST(o_custkey AS string)) AS folder,
         concat('ds_', CAST(o_custkey AS string)) AS datasetcode, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS datasetversion,
         CAST(year(o_orderdate) AS int) AS year, CAST(month(o_orderdate) AS int) AS month, count(*) AS files,
         CAST(sum(CAST(round(o_totalprice) AS bigint)) AS bigint) AS byte,
         max(lpad(printf('%x', CAST(floor(epoch(o_orderdate)) AS bigint)), 8, '0') || lpad(CAST(o_orderkey AS string), 16, '0')) AS max_oid
       FROM {orders} GROUP BY o_custkey, CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END, year(o_orderdate), month(o_orderdate)
       HAVING count(*) > 1""",
)
def compaction_file_groups(t: Inputs) -> DataFrame:
    from tidemark.plans.compaction import file_groups, with_month

    return file_groups(with_month(name_parts(t("x_rawfile")))).drop("parts")
