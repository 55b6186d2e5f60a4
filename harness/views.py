"""Inputs of the jobs, mapped onto the test tables.

Each text runs unchanged on Spark and on DuckDB; ``{name}`` refers to a test table or to another entry.
Every entry covers its whole tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import bucketed

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

CENTS = "CAST(round(l_extendedprice * 100) AS bigint)"

_PERSON = """
  CASE WHEN {bal} < 0 THEN 'undefined' ELSE 'yes' END AS hasstage,
  CASE WHEN {bal} < 1000 THEN 'undefined' ELSE 'lab' END AS zeppelin,
  CASE WHEN {bal} < 500 THEN 'undefined' ELSE '2015-01-01' END AS dataattivazione,
  CASE WHEN {bal} > 9000 THEN '2020-12-31' ELSE 'undefined' END AS datadisattivazione,
  CASE WHEN {bal} < 0 THEN 'suspended' ELSE 'active' END AS coddeploymentstatus,
  concat('Last', {name}) AS userlastname, concat('First', {name}) AS userfirstname,
  concat(lower({name}), '@example.org') AS useremail
"""

VIEWS: dict[str, str] = {}

# tenants: customers own datasets, suppliers own none
VIEWS["x_tenant"] = f"""
SELECT concat('T', CAST(c_custkey AS string)) AS tenantcode, c_custkey AS idtenant, c_name AS tenantname,
  n_name AS organizationcode, r_name AS idecosystem, c_mktsegment AS tenanttype,
  {_PERSON.format(bal='c_acctbal', name='c_name')}
FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
UNION ALL
SELECT concat('S', CAST(s_suppkey AS string)), 1000000000 + s_suppkey, s_name, n_name, r_name, 'SUPPLIER',
  {_PERSON.format(bal='s_acctbal', name='s_name')}
FROM {{supplier}} JOIN {{nation}} ON s_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
"""

# dataset versions: one dataset per order, one version per line number
VIEWS["x_dataset"] = """
SELECT o_orderkey AS iddataset, l_linenumber AS datasetversion,
  concat('ds_', CAST(o_orderkey AS string)) AS datasetcode, concat('T', CAST(o_custkey AS string)) AS tenantcode,
  CASE o_orderstatus WHEN 'F' THEN 'inst' ELSE 'req' END AS datasetstatus,
  CASE o_orderkey % 4 WHEN 0 THEN 'bulkDataset' WHEN 1 THEN 'streamDataset' WHEN 2 THEN 'socialDataset'
    ELSE 'binaryDataset' END AS sottotipo,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'MULTI' ELSE o_orderpriority END AS datadomain,
  CASE o_orderstatus WHEN 'P' THEN '' ELSE lower(o_orderpriority) END AS codsubdomain,
  o_custkey AS binaryiddataset, l_linenumber AS binarydatasetversion,
  concat('coll_', CAST(o_orderkey % 97 AS string)) AS solrcollectionname,
  concat('Order', chr(10), o_orderpriority) AS descrds,
  CASE o_orderstatus WHEN 'O' THEN 'public' ELSE 'private' END AS visibility,
  concat('tag_', lower(o_orderstatus)) AS elencotag,
  concat('db_', lower(o_orderstatus)) AS dbhiveschema, concat('tb_', CAST(o_orderkey AS string)) AS dbhivetable
FROM {orders} JOIN (SELECT DISTINCT l_orderkey, l_linenumber FROM {lineitem}) l ON l_orderkey = o_orderkey
"""

VIEWS["x_dim_dataset"] = f"""
SELECT concat('ds_', CAST(l_orderkey AS string)) AS datasetcode, l_linenumber AS datasetversion,
  CAST(sum({CENTS}) AS bigint) AS num_bytes, count(*) AS num_rows
FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber
"""

# only returned and accepted lines reached the serving store under their number: the others' key matches no dataset
VIEWS["x_serving_dim"] = """
SELECT CASE l_returnflag WHEN 'N' THEN l_orderkey + 1000000000 ELSE l_orderkey END AS iddataset, l_linenumber AS datasetversion,
  count(*) AS numrecord, max(l_shipdate) AS lasttimeid
FROM {lineitem} GROUP BY CASE l_returnflag WHEN 'N' THEN l_orderkey + 1000000000 ELSE l_orderkey END, l_linenumber
"""

VIEWS["x_catalog"] = f"""
SELECT concat('db_', lower(o_orderstatus)) AS db_name, upper(concat('tb_', CAST(o_orderkey AS string))) AS tbl_name,
  CAST(sum({CENTS}) AS string) AS total_size, CAST(count(*) AS string) AS num_rows
FROM {{orders}} JOIN {{lineitem}} ON l_orderkey = o_orderkey GROUP BY o_orderstatus, o_orderkey
UNION ALL
SELECT concat('transf_', lower(p_type)),
  CASE WHEN p_brand = 'Brand#1' THEN concat('db_catalog_', CAST(p_partkey AS string))
    ELSE concat('part_', CAST(p_partkey AS string)) END,
  CAST(p_partkey * 1000 AS string), CAST(p_size AS string)
FROM {{part}}
UNION ALL
SELECT concat('private_', lower(p_type)), concat('part_', CAST(p_partkey AS string)), CAST(p_size AS string), '1'
FROM {{part}}
UNION ALL
SELECT 'db_log', concat('log_', CAST(s_suppkey AS string)), '7', '1' FROM {{supplier}}
"""

VIEWS["x_owner"] = """
SELECT concat('T', CAST(min(p_partkey) AS string)) AS tenantcode, concat('transf_', lower(p_type)) AS db_hive
FROM {part} GROUP BY p_type
"""

VIEWS["x_stream"] = """
SELECT concat('T', CAST(o_custkey AS string)) AS tenantcode, l_suppkey AS idvirtualentity, l_partkey AS idstream
FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey
"""

VIEWS["x_space"] = f"""
SELECT concat(CAST(bytes AS string), '   /serving/', name) AS line
FROM (SELECT CASE l_linestatus WHEN 'F' THEN concat('COLL_', CAST(l_orderkey % 97 AS string))
        ELSE concat('coll_', CAST(l_orderkey % 97 AS string)) END AS name, CAST(sum({CENTS}) AS bigint) AS bytes
      FROM {{lineitem}} GROUP BY l_orderkey % 97, l_linestatus) t
"""

VIEWS["x_stage"] = """
SELECT concat(CAST(bytes AS string), '  /datalake/ORG/dataset_transformed/STAGE/T', CAST(o_custkey AS string), '/',
  o_orderstatus, '/files') AS line
FROM (SELECT o_custkey, o_orderstatus, CAST(sum(CAST(round(o_totalprice * 100) AS bigint)) AS bigint) AS bytes
      FROM {orders} GROUP BY o_custkey, o_orderstatus) t
UNION ALL
SELECT concat('10 /datalake/', r_name, '/dataset_transformed/STAGE/', r_name) FROM {region}
"""

VIEWS["x_calls"] = """
SELECT concat('T', CAST(o_custkey AS string)) AS tenant, CAST(year(o_orderdate) AS int) AS year,
  CAST(month(o_orderdate) AS int) AS month, o_orderstatus AS server, count(*) AS num_chiamate_mese,
  count(DISTINCT o_orderpriority) AS fruitori_distinti_tenant, max(o_orderdate) AS ultima_chiamata
FROM {orders} GROUP BY o_custkey, year(o_orderdate), month(o_orderdate), o_orderstatus
"""

VIEWS["x_register"] = """
SELECT concat(CASE WHEN c_acctbal > 0 THEN 'T' ELSE 'none_' END, CAST(c_custkey AS string)) AS tenantcode, concat('eco_', CAST(c_nationkey AS string)) AS idecosystem,
  c_mktsegment AS ecosistema, c_name AS ente_pagante, 'yes' AS incaricato_trattamento, c_mktsegment AS progetto,
  CASE WHEN c_acctbal > 5000 THEN 'yes' ELSE 'no' END AS in_consuntivo,
  CASE WHEN c_acctbal > 7000 THEN 'yes' ELSE 'no' END AS pagante, 'prep' AS modulo_data_prep,
  'inout' AS modulo_data_in_out, concat('note; ', c_name) AS note
FROM {customer}
"""

# serving documents, users spread over 40 datasets; the id starts with the event's second and ends with its number
_SERVING = """
SELECT concat({hex}, lpad(CAST(event_id AS string), 16, '0')) AS id, user_id % 40 AS iddataset_l,
  CAST(CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 2 END AS bigint) AS datasetversion_l,
  CASE event_type WHEN 'view' THEN 'speed' ELSE 'datalake' END AS origin_s, ts AS time_dt, event_type AS type_s,
  value AS value_d, CASE event_type WHEN 'click' THEN '' WHEN 'signup' THEN NULL
    WHEN 'error' THEN concat('say "', props, '"; a,b', chr(10), ' end ') ELSE props END AS note_s
FROM {events}
"""
_SPARK_SECOND = "lpad(lower(hex(unix_seconds(CAST({ts} AS timestamp)))), 8, '0')"
_DUCK_SECOND = "lpad(printf('%x', CAST(floor(epoch({ts})) AS bigint)), 8, '0')"
VIEWS["x_serving"] = _SERVING.replace("{hex}", _SPARK_SECOND.format(ts="ts"))

# the same documents with one dataset per kind of event
VIEWS["x_doc"] = """
SELECT id, CAST(CASE type_s WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'purchase' THEN 4
  ELSE 5 END AS bigint) AS iddataset_l, CAST(CASE WHEN value_d < 10 THEN 1 ELSE 2 END AS bigint) AS datasetversion_l,
  CASE WHEN value_d < 5 THEN 'speed' ELSE 'datalake' END AS origin_s, time_dt, type_s, value_d, note_s
FROM {x_serving}
"""

# what earlier runs exported: nothing for datasets without an early error, all there will ever be for busy ones
VIEWS["x_state"] = """
SELECT iddataset, datasetversion_l AS datasetversion, CASE WHEN count(*) >= 3 THEN 'f48648f00000000000000000' ELSE max(id) END AS last_id
FROM (SELECT CASE WHEN type_s IN ('error', 'view') AND time_dt < TIMESTAMP '2024-01-01 06:00:00' THEN iddataset_l ELSE iddataset_l + 1000000000 END
        AS iddataset, datasetversion_l, id FROM {x_serving}) s
GROUP BY iddataset, datasetversion_l
"""

# lake rows of one stream dataset
VIEWS["x_lake"] = """
SELECT CAST(substring(id, 9) AS bigint) + 1 AS sparkuniqueid, id AS bda_id, origin_s AS bda_origin, time_dt AS bda_time,
  type_s AS bda_sensor, concat('str_', CAST(iddataset_l AS string)) AS bda_streamcode, type_s AS Kind,
  value_d AS reading, iddataset_l AS Counter, time_dt AS Seen, CAST(value_d AS string) AS level, note_s AS note
FROM {x_serving}
"""

# small raw files: one per order, filed by customer
_RAWFILE = """
SELECT concat('/datalake/ORG/rawdata/D/so_x/', CAST(o_custkey AS string), '/', {hex}, lpad(CAST(o_orderkey AS string), 16, '0'),
  '_', CAST(o_orderkey AS string), '-ds_', CAST(o_custkey AS string), '-', CASE o_orderstatus WHEN 'F' THEN '1' ELSE '2' END,
  '.csv') AS path, CAST(round(o_totalprice) AS bigint) AS byte
FROM {orders}
"""
VIEWS["x_rawfile"] = _RAWFILE.replace("{hex}", _SPARK_SECOND.format(ts="o_orderdate"))

# texts that differ on DuckDB, and pieces only the oracle uses
DUCK_VIEWS = {
    "x_serving": _SERVING.replace("{hex}", _DUCK_SECOND.format(ts="ts")),
    "x_rawfile": _RAWFILE.replace("{hex}", _DUCK_SECOND.format(ts="o_orderdate")),
}

VIEWS["x_param"] = """
SELECT event_id AS tbl_id, 'numRows' AS param_key, CAST(user_id AS string) AS param_value FROM {events}
UNION ALL
SELECT CASE event_type WHEN 'error' THEN event_id + 1000000000 ELSE event_id END, 'totalSize', CAST(event_id * 1000 AS string) FROM {events}
UNION ALL
SELECT event_id, 'comment', event_type FROM {events}
"""

VIEWS["x_table"] = """
SELECT event_id AS tbl_id, user_id AS db_id, event_id AS sd_id, concat('tb_', CAST(event_id AS string)) AS tbl_name,
  CASE event_type WHEN 'signup' THEN 'EXTERNAL_TABLE' ELSE 'MANAGED_TABLE' END AS tbl_type,
  1400000000 + event_id * 3600 AS create_time
FROM {events}
"""

VIEWS["x_database"] = """
SELECT DISTINCT user_id AS db_id, CASE user_id % 3 WHEN 0 THEN concat('db_', CAST(user_id AS string))
  WHEN 1 THEN concat('transf_', CAST(user_id AS string)) ELSE concat('hr_', CAST(user_id AS string)) END AS name
FROM {events}
"""

VIEWS["x_storage"] = """
SELECT CASE event_type WHEN 'view' THEN event_id + 1000000000 ELSE event_id END AS sd_id, concat('/warehouse/', CAST(event_id AS string)) AS location
FROM {events}
"""

# log rows: text columns of every layout, some with unreadable or ISO times
VIEWS["x_log"] = """
SELECT CASE event_type WHEN 'error' THEN '-' WHEN 'signup' THEN replace(CAST(ts AS string), ' ', 'T')
    ELSE CAST(ts AS string) END AS log_timestamp,
  CAST(CAST(floor(event_id / 2) AS bigint) AS string) AS uniqueid,
  CASE WHEN event_id % 2 = 0 THEN concat('10.0.0.', CAST(user_id AS string)) ELSE '-' END AS forwardedfor,
  concat('jwt_', CAST(user_id AS string)) AS jwt, concat('/api/', event_type) AS path,
  concat('ds_', CAST(user_id AS string)) AS apicode,
  CASE event_type WHEN 'click' THEN '-' WHEN 'view' THEN '|' ELSE concat('ds_', CAST(user_id AS string)) END AS datasetcode,
  CASE event_type WHEN 'purchase' THEN '-' WHEN 'view' THEN '|' ELSE concat('T', CAST(user_id AS string)) END AS tenant,
  event_type AS query, CAST(user_id AS string) AS nrecin, CAST(event_id AS string) AS nrecout,
  CAST(event_id % 1000 AS string) AS elapsed, '-' AS error_bsn, concat('s', CAST(user_id AS string)) AS error_servlet
FROM {events}
"""

# lake rows: one per order, plus the same rows as stream measurements
VIEWS["x_row"] = """
SELECT o_orderkey, concat('0000', lpad(CAST(o_orderkey AS string), 20, '0')) AS rowkey, o_orderdate AS bda_time,
  o_orderpriority AS bda_sensor, o_orderstatus AS bda_streamcode, o_totalprice, o_custkey
FROM {orders}
"""

# normalized catalogue tables
VIEWS["m_tenant"] = """
SELECT idtenant AS id_tenant, tenantcode, tenantname AS name, concat('Tenant ', tenantname) AS description,
  n_nationkey AS id_organization, tenanttype AS id_tenant_type, coddeploymentstatus AS id_tenant_status,
  dataattivazione AS activationdate, datadisattivazione AS deactivationdate, idecosystem AS id_ecosystem,
  lower(tenantname) AS username, userlastname, userfirstname, useremail, 'strong' AS usertypeauth
FROM {x_tenant} JOIN {nation} ON n_name = organizationcode
"""
VIEWS["m_organization"] = """
SELECT n_nationkey AS id_organization, n_name AS organizationcode,
  concat('data_', n_name) AS datasolrcollectionname, concat('measures_', n_name) AS measuressolrcollectionname,
  concat('social_', n_name) AS socialsolrcollectionname, concat('media_', n_name) AS mediasolrcollectionname,
  concat('pd_', n_name) AS dataphoenixtablename, concat('pm_', n_name) AS measuresphoenixtablename,
  concat('ps_', n_name) AS socialphoenixtablename, concat('pe_', n_name) AS mediaphoenixtablename,
  concat('sd_', n_name) AS dataphoenixschemaname, concat('sm_', n_name) AS measuresphoenixschemaname,
  concat('ss_', n_name) AS socialphoenixschemaname, concat('se_', n_name) AS mediaphoenixschemaname
FROM {nation}
"""
VIEWS["m_tenant_type"] = """
SELECT DISTINCT tenanttype AS id_tenant_type, concat('type_', lower(tenanttype)) AS tenanttypecode FROM {x_tenant}
"""
VIEWS["m_tenant_status"] = """
SELECT DISTINCT coddeploymentstatus AS id_tenant_status, concat('st_', coddeploymentstatus) AS tenantstatuscode
FROM {x_tenant}
"""
VIEWS["m_bundle"] = """
SELECT DISTINCT tenanttype AS id_bundles, CASE tenanttype WHEN 'SUPPLIER' THEN 'undefined' ELSE 'yes' END AS hasstage,
  lower(tenanttype) AS zeppelin
FROM {x_tenant}
"""
VIEWS["m_tenant_bundle"] = "SELECT idtenant AS id_tenant, tenanttype AS id_bundles FROM {x_tenant}"
VIEWS["m_data_source"] = """
SELECT l_orderkey AS id_data_source, l_linenumber AS datasourceversion, c_nationkey AS id_organization,
  CASE open_lines WHEN 0 THEN 'F' ELSE 'O' END AS id_status, o_orderpriority AS id_subdomain,
  CASE o_orderstatus WHEN 'P' THEN NULL ELSE o_orderstatus END AS id_license,
  CASE o_orderstatus WHEN 'O' THEN 'public' ELSE 'private' END AS visibility, o_custkey AS id_manager
FROM (SELECT l_orderkey, l_linenumber, max(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END) AS open_lines
      FROM {lineitem} GROUP BY l_orderkey, l_linenumber) l
JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON o_custkey = c_custkey
"""
VIEWS["m_status"] = "SELECT DISTINCT l_linestatus AS id_status, CASE l_linestatus WHEN 'F' THEN 'inst' ELSE 'req' END AS statuscode FROM {lineitem}"
VIEWS["m_subdomain"] = "SELECT DISTINCT o_orderpriority AS id_subdomain, lower(o_orderpriority) AS subdomaincode, substring(o_orderpriority, 1, 1) AS id_domain FROM {orders}"
VIEWS["m_domain"] = "SELECT DISTINCT substring(o_orderpriority, 1, 1) AS id_domain, concat('dom_', substring(o_orderpriority, 1, 1)) AS domaincode FROM {orders}"
VIEWS["m_license"] = "SELECT DISTINCT o_orderstatus AS id_license, concat('CC ', o_orderstatus) AS licensecode FROM {orders}"
VIEWS["m_tenant_data_source"] = """
SELECT id_data_source, datasourceversion, id_manager AS id_tenant, 1 AS ismanager, 1 AS isactive FROM {m_data_source}
UNION ALL
SELECT l_orderkey, l_linenumber, 1000000000 + l_suppkey, 0, max(CASE l_returnflag WHEN 'R' THEN 1 ELSE 0 END)
FROM {lineitem} GROUP BY l_orderkey, l_linenumber, l_suppkey
"""
VIEWS["m_dataset"] = """
SELECT id_data_source, datasourceversion, id_data_source AS iddataset,
  concat('ds_', CAST(id_data_source AS string)) AS datasetcode, concat('Dataset ', CAST(id_data_source AS string)) AS datasetname,
  concat('About ', id_subdomain) AS description, id_subdomain AS id_dataset_type, id_data_source % 4 AS id_dataset_subtype,
  CASE id_status WHEN 'F' THEN NULL ELSE concat('coll_', CAST(id_data_source % 97 AS string)) END AS solrcollectionname,
  CASE id_status WHEN 'O' THEN NULL ELSE concat('tab_', CAST(id_data_source AS string)) END AS phoenixtablename,
  CASE visibility WHEN 'public' THEN 'open' ELSE NULL END AS phoenixschemaname,
  concat('db_', lower(id_status)) AS dbhiveschema, concat('tb_', CAST(id_data_source AS string)) AS dbhivetable,
  id_manager AS id_data_source_binary, datasourceversion AS datasourceversion_binary,
  CASE visibility WHEN 'public' THEN 1 ELSE 0 END AS isopendata, id_subdomain AS opendataauthor
FROM {m_data_source}
"""
VIEWS["m_dataset_type"] = "SELECT DISTINCT o_orderpriority AS id_dataset_type, concat('type ', o_orderpriority) AS dataset_type FROM {orders}"
VIEWS["m_dataset_subtype"] = """
SELECT DISTINCT o_orderkey % 4 AS id_dataset_subtype, CASE o_orderkey % 4 WHEN 0 THEN 'bulkDataset'
  WHEN 1 THEN 'streamDataset' WHEN 2 THEN 'socialDataset' ELSE 'binaryDataset' END AS dataset_subtype
FROM {orders}
"""
VIEWS["m_component"] = """
SELECT l_orderkey AS id_data_source, l_linenumber AS datasourceversion, concat('part_', CAST(l_partkey AS string)) AS name
FROM {lineitem}
"""
VIEWS["m_source_tag"] = """
SELECT DISTINCT l_orderkey AS id_data_source, l_linenumber AS datasourceversion, p_brand AS id_tag
FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
"""
VIEWS["m_tag"] = "SELECT DISTINCT p_brand AS id_tag, lower(p_brand) AS tagcode FROM {part}"
VIEWS["m_stream"] = """
SELECT CASE l_linestatus WHEN 'O' THEN l_orderkey ELSE l_orderkey + 1000000000 END AS id_data_source, l_linenumber AS datasourceversion,
  l_orderkey * 10 + l_linenumber AS idstream,
  concat('str_', CAST(l_orderkey AS string)) AS streamcode, concat('Stream ', CAST(l_orderkey AS string)) AS streamname,
  max(l_suppkey) AS id_smart_object
FROM {lineitem} GROUP BY l_linestatus, l_orderkey, l_linenumber
"""
VIEWS["m_smart_object"] = """
SELECT s_suppkey AS id_smart_object, s_name AS name, concat('Object ', s_name) AS description,
  concat('so ', lower(s_name)) AS slug, concat('so_', CAST(s_suppkey AS string)) AS socode,
  s_nationkey AS id_so_type, n_regionkey AS id_so_category
FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""
VIEWS["m_so_type"] = "SELECT n_nationkey AS id_so_type, n_name AS sotypecode FROM {nation}"
VIEWS["m_so_category"] = "SELECT r_regionkey AS id_so_category, r_name AS socategorycode FROM {region}"
VIEWS["m_api"] = """
SELECT id_data_source, datasourceversion, id_data_source * 10 + datasourceversion AS idapi,
  concat('Api ', CAST(id_data_source AS string)) AS apiname, concat('api_', CAST(id_data_source AS string)) AS apicode,
  'odata' AS apitype, id_status AS apisubtype, concat('ns.', id_status) AS entitynamespace
FROM {m_data_source}
"""

# dataset rows as the selectors and descriptors see them
VIEWS["x_choice"] = """
SELECT d.iddataset, d.datasetversion, d.datasetcode, d.tenantcode, d.sottotipo, d.datadomain, d.codsubdomain,
  t.organizationcode, CASE d.datasetstatus WHEN 'inst' THEN 'installed' ELSE 'requested' END AS datasetstatus_desc,
  CASE d.visibility WHEN 'public' THEN 5 ELSE 2 END AS idstatus,
  CASE d.sottotipo WHEN 'binaryDataset' THEN 3 WHEN 'bulkDataset' THEN 1 ELSE 2 END AS idsubtype,
  d.datadomain <> '5-LOW' AS availablespeed, CASE d.datadomain WHEN 'MULTI' THEN 'HIVE' ELSE 'ORACLE' END AS jdbcdbtype,
  CASE d.sottotipo WHEN 'socialDataset' THEN 'elsewhere' ELSE 'datalake' END AS jdbcdburl,
  d.datasetstatus = 'inst' AS istransformed
FROM {x_dataset} d JOIN {x_tenant} t ON d.tenantcode = t.tenantcode
"""
VIEWS["x_member"] = """
SELECT DISTINCT l_suppkey AS idgroup, l_linenumber AS groupversion, l_orderkey AS iddataset FROM {lineitem}
"""
VIEWS["x_component"] = """
SELECT l_orderkey AS iddataset, l_linenumber AS datasetversion, l_partkey AS position,
  concat('Field_', CAST(l_partkey AS string)) AS name,
  CASE p_type WHEN 'ECONOMY' THEN 'string' WHEN 'SMALL' THEN 'double' WHEN 'LARGE' THEN 'dateTime'
    WHEN 'MEDIUM' THEN 'int' ELSE 'float' END AS datatype
FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM {lineitem}) l JOIN {part} ON l_partkey = p_partkey
"""
VIEWS["x_dataset_stream"] = """
SELECT l_orderkey AS iddataset, l_linenumber AS datasetversion, concat('str_', CAST(l_orderkey AS string)) AS streamcode,
  concat('so ', CAST(max(l_suppkey) AS string), '/x') AS slug
FROM {lineitem} GROUP BY l_orderkey, l_linenumber
"""


SOURCE = ("id_data_source", "datasourceversion")


def _streams(t: Inputs) -> DataFrame:
    lines = t("lineitem").select(
        F.when(F.col("l_linestatus") == "O", F.col("l_orderkey")).otherwise(F.col("l_orderkey") + 1000000000).alias("id_data_source"),
        F.col("l_linenumber").alias("datasourceversion"), "l_linestatus", "l_orderkey", "l_suppkey",
    )
    number = F.col("l_orderkey").cast("string")
    grouped = lines.repartition(*SOURCE).groupBy(*SOURCE, "l_linestatus", "l_orderkey").agg(F.max("l_suppkey").alias("id_smart_object"))
    return grouped.select(
        *SOURCE, (F.col("l_orderkey") * 10 + F.col("datasourceversion")).alias("idstream"),
        F.concat(F.lit("str_"), number).alias("streamcode"), F.concat(F.lit("Stream "), number).alias("streamname"), "id_smart_object",
    )


def _source_tags(t: Inputs) -> DataFrame:
    tagged = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
    columns = {"l_orderkey": "id_data_source", "l_linenumber": "datasourceversion", "p_brand": "id_tag"}
    return tagged.select(*[F.col(a).alias(b) for a, b in columns.items()]).repartition(*SOURCE).distinct()


# the rows of a view, dealt out by data source and version before it groups them, so that joins and lists need no second shuffle
BY_SOURCE = {"m_stream": _streams, "m_source_tag": _source_tags}


# tables that a view groups by more columns than it then joins on: dealt out by the join's key, they need one shuffle for both
DEALT = {"x_dataset": {"lineitem": "l_orderkey"}, "m_data_source": {"lineitem": "l_orderkey"}}


def references(text: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", text)))


class Inputs:
    """Frames of one data folder, by table or view name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}
        self._kept: dict[str, tuple[str, ...]] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in TABLES:
                self._frames[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                self._frames[name] = self.sql(VIEWS[name], DEALT.get(name, {}))
        return self._frames[name]

    def kept(self, name: str, *keys: str, columns: str = "*") -> DataFrame:
        """A table or view written down once, for queries that use it many times; views that are built from it later read the copy.

        Each use of it takes other columns, so Spark can't share its shuffles among them. The copy is bucketed by
        ``keys``, so it is joined and grouped on them without a shuffle. It holds all ``columns`` that the query's views take.
        """
        if name not in self._kept:
            self._frames[name] = bucketed(self(name).select(*columns.split()), name, *keys)
            self._kept[name] = keys
        return self._frames[name]

    def by_source(self, name: str) -> DataFrame:
        """A view of ``BY_SOURCE``, laid out for joins and groups by data source and version."""
        return BY_SOURCE[name](self)

    def sql(self, text: str, dealt: dict[str, str] | None = None) -> DataFrame:
        """The frame of a text; ``dealt`` names the tables whose rows are dealt out by a column first, if they don't lie so."""
        frames = {name: self(name) for name in references(text)}
        for name, column in (dealt or {}).items():
            if self._kept.get(name) != (column,):
                frames[name] = frames[name].repartition(column)
        return self.spark.sql(text, **frames)


def oracle_text(text: str) -> str:
    """A DuckDB query from a text with references: the views it needs come first, in order of use."""
    ordered: list[str] = []

    def duck(name: str) -> str:
        return DUCK_VIEWS.get(name) or VIEWS[name]

    def need(name: str) -> None:
        if name in TABLES or name in ordered:
            return
        for inner in references(duck(name)):
            need(inner)
        ordered.append(name)

    for name in references(text):
        need(name)

    def plain(sql: str) -> str:
        return re.sub(r"\{(\w+)\}", r"\1", sql).strip()

    heads = ",\n".join(f"{name} AS MATERIALIZED ({plain(duck(name))})" for name in ordered)
    body = plain(text)
    if not heads:
        return body
    return f"WITH {heads},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {heads}\n{body}"
