"""Governance and metadata marts, and the reports written from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harness.queries_core import OWNED, UNOWNED
from harness.registry import plain_types, query
from harness.views import DUCK_VIEWS, Inputs
from tidemark.plans import catalog, governance, marts, metadata, reports, space
from tidemark.session import scratch_path
from tidemark.sinks.tables import save_table, snapshot
from tidemark.sources.listing import parse_collection_listing, parse_stage_listing

YEAR = 2000  # the year the usage register reports on
OWN_DATABASES, SERVING_ROOT = ["db_log"], "/serving"

# ---------------------------------------------------------------- oracle pieces

_MB = "round(%s / (1024 * 1024), 1)"


def _oracle_view(name: str, text: str) -> str:
    DUCK_VIEWS[name] = text
    return text


# the tenant's fields once, with the last day that any of its datasets was served
TENANT_INFO = _oracle_view("o_info", """
WITH served AS (
  SELECT tenantcode, strftime(max(lasttimeid) FILTER (lasttimeid > TIMESTAMP '1970-01-01 01:00:00'), '%Y-%m-%d') AS last_day
  FROM {x_dataset} JOIN {x_serving_dim} USING (iddataset, datasetversion) GROUP BY tenantcode
)
SELECT DISTINCT idecosystem, tenanttype, organizationcode, tenantname, tenantcode, userlastname || ' ' || userfirstname AS referente,
  useremail AS email_referente, last_day AS dataultimoaggiornamento, if(zeppelin = 'undefined', '', zeppelin) AS zeppelin,
  if(hasstage = 'undefined', '', hasstage) AS stage, if(dataattivazione = 'undefined', '', dataattivazione) AS dataattivazione,
  if(datadisattivazione = 'undefined', '', datadisattivazione) AS datadisattivazione
FROM {x_tenant} LEFT JOIN served USING (tenantcode)
""")
TABLE_SIZES = _oracle_view("o_tables", f"{UNOWNED} UNION ALL {OWNED}")
LAKE_MB = _oracle_view("o_lake", f"""
SELECT t.tenantcode AS tenant, coalesce({_MB % 'max(size)'}, 0.0) AS "hive_dim_MB" FROM {{x_tenant}} t
LEFT JOIN (SELECT tenantcode, sum(CAST(total_size AS bigint)) AS size FROM {{o_tables}} GROUP BY tenantcode) s
  ON s.tenantcode = t.tenantcode GROUP BY t.tenantcode
""")
CSV_MB = _oracle_view("o_csv", f"""
SELECT t.tenantcode AS tenant, coalesce({_MB % 'sum(num_bytes)'}, 0.0) AS "hdfs_csv_dim_MB" FROM {{x_tenant}} t
LEFT JOIN {{x_dataset}} d ON d.tenantcode = t.tenantcode
LEFT JOIN {{x_dim_dataset}} s ON s.datasetcode = d.datasetcode AND s.datasetversion = d.datasetversion GROUP BY t.tenantcode
""")
BINARY_MB = _oracle_view("o_binary", f"""
SELECT t.tenantcode AS tenant, coalesce({_MB % 'sum(num_bytes)'}, 0.0) AS "bin_dim_MB" FROM {{x_tenant}} t
LEFT JOIN (SELECT DISTINCT tenantcode, binaryiddataset, binarydatasetversion FROM {{x_dataset}}) b ON b.tenantcode = t.tenantcode
LEFT JOIN {{x_dim_dataset}} s ON s.datasetcode = concat('ds_', CAST(b.binaryiddataset AS string))
  AND s.datasetversion = b.binarydatasetversion GROUP BY t.tenantcode
""")
COLLECTION_BYTES = _oracle_view("o_bytes", """
SELECT tenantcode, avg(CAST(regexp_extract(line, '^([0-9]+)', 1) AS bigint)) AS solr_byte, solrcollectionname
FROM {x_dataset} LEFT JOIN {x_space} ON upper(split_part(line, '/serving/', 2)) = upper(solrcollectionname)
GROUP BY tenantcode, solrcollectionname
""")
# a tenant's part of a collection's bytes is its part of the collection's records
SERVING_MB = _oracle_view("o_serving", f"""
WITH records AS (
  SELECT tenantcode, solrcollectionname, sum(numrecord) AS own, sum(sum(numrecord)) OVER (PARTITION BY solrcollectionname) AS everyones
  FROM {{x_dataset}} LEFT JOIN {{x_serving_dim}} USING (iddataset, datasetversion) GROUP BY tenantcode, solrcollectionname
), parts AS (
  SELECT tenantcode, sum(solr_byte * own / everyones) AS bytes FROM records JOIN {{o_bytes}} USING (tenantcode, solrcollectionname) GROUP BY tenantcode
)
SELECT tenantcode AS tenant, {_MB % 'coalesce(bytes, 0.0)'} AS solrtenantcollmb FROM (SELECT DISTINCT tenantcode FROM {{x_tenant}}) t LEFT JOIN parts USING (tenantcode)
""")
STAGE_BYTES = _oracle_view("o_stage_bytes", """
SELECT regexp_extract(line, '^([0-9]+)', 1) AS byte, regexp_extract(line, '^[0-9]+\\s+(.*)$', 1) AS stg_path,
  regexp_extract(line, 'STAGE/([^/]*)/', 1) AS tenantcode FROM {x_stage}
""")
STAGE_MB = _oracle_view("o_stage", f"""
SELECT t.tenantcode AS tenant, coalesce({_MB % 'sum(CAST(byte AS bigint))'}, 0.0) AS hdfs_stage_dim FROM {{x_tenant}} t
LEFT JOIN {{o_stage_bytes}} s ON s.tenantcode = t.tenantcode GROUP BY t.tenantcode
""")
OBJECT_COUNTS = _oracle_view("o_objects", """
SELECT t.tenantcode AS tenant, count(DISTINCT idvirtualentity) AS num_smartobjects, count(DISTINCT idstream) AS num_streams,
  count(DISTINCT idvirtualentity) + count(DISTINCT idstream) AS tot_so_stream
FROM {x_tenant} t LEFT JOIN {x_stream} s ON s.tenantcode = t.tenantcode GROUP BY t.tenantcode
""")
TENANT_CARD = _oracle_view("o_card", """
SELECT i.*, l.tenant, "hive_dim_MB", "hdfs_csv_dim_MB", "bin_dim_MB", solrtenantcollmb, hdfs_stage_dim, num_smartobjects,
  num_streams, tot_so_stream, "hive_dim_MB" + "hdfs_csv_dim_MB" + "bin_dim_MB" + solrtenantcollmb + hdfs_stage_dim AS "dimTotale"
FROM {o_info} i LEFT JOIN {o_lake} l ON l.tenant = i.tenantcode LEFT JOIN {o_csv} c ON c.tenant = l.tenant
LEFT JOIN {o_binary} b ON b.tenant = l.tenant LEFT JOIN {o_serving} s ON s.tenant = l.tenant
LEFT JOIN {o_stage} g ON g.tenant = l.tenant LEFT JOIN {o_objects} o ON o.tenant = l.tenant
""")
CALLS_MONTHLY = _oracle_view("o_monthly", """
SELECT tenant AS tenantcode, year AS anno, month AS mese, CAST(sum(num_chiamate_mese) AS bigint) AS num_chiamate_mese,
  max(fruitori_distinti_tenant) AS fruitori_distinti, sum(num_chiamate_mese) / 2592000 AS media_al_sec,
  max(ultima_chiamata) AS ultima_chiamata FROM {x_calls} GROUP BY tenant, year, month
""")
CALLS_YEARLY = _oracle_view("o_yearly", """
SELECT m.tenantcode, anno, sum(num_chiamate_mese) / count(mese) AS media_chiamate_anno, max(datadisattivazione) AS datadisattivazione
FROM {o_monthly} m JOIN {o_info} i ON i.tenantcode = m.tenantcode GROUP BY m.tenantcode, anno
""")
CALLS = _oracle_view("o_calls", """
SELECT m.*, media_chiamate_anno, datadisattivazione FROM {o_monthly} m
JOIN {o_yearly} y ON y.tenantcode = m.tenantcode AND y.anno = m.anno
""")
DATASET_LIST = _oracle_view("o_list", """
SELECT organizationcode AS organizzazione, tenantname, t.tenantcode, datadisattivazione, d.iddataset AS codice_dataset,
  datasetstatus AS status, datasetcode AS nome_dataset, replace(descrds, chr(10), ' ') AS descr_dataset, visibility AS visibilita,
  datadomain AS dominio, codsubdomain AS sottodominio, elencotag AS tag
FROM {x_tenant} t JOIN {x_dataset} d ON d.tenantcode = t.tenantcode
JOIN (SELECT iddataset, max(datasetversion) AS v FROM {x_dataset} GROUP BY iddataset) m
  ON m.iddataset = d.iddataset AND m.v = d.datasetversion
""")
USAGE = _oracle_view("o_usage", f"""
SELECT r.idecosystem, ecosistema, ente_pagante, organizationcode AS ente_titolare, incaricato_trattamento, progetto, tenantname,
  c.tenantcode, tenanttype, referente, email_referente, dataultimoaggiornamento, dataattivazione, datadisattivazione, in_consuntivo,
  pagante, "dimTotale", odata, num_smartobjects, num_streams, tot_so_stream, modulo_data_prep, modulo_data_in_out, dataset, note
FROM {{o_card}} c
LEFT JOIN (SELECT tenantcode, count(codice_dataset) AS dataset FROM {{o_list}} GROUP BY tenantcode) d ON d.tenantcode = c.tenantcode
LEFT JOIN (SELECT DISTINCT tenantcode, media_chiamate_anno AS odata FROM {{o_calls}} WHERE anno = {YEAR}) a ON a.tenantcode = c.tenantcode
LEFT JOIN {{x_register}} r ON r.tenantcode = c.tenantcode
""")
# each tenant's datasets summed up on their own, then put beside the tenant
RECORDS = _oracle_view("o_records", """
WITH facts AS (
  SELECT tenantcode, count(DISTINCT d.iddataset) AS dataset, sum(num_rows) AS num_rows, max(lasttimeid) AS last_seen
  FROM {x_dataset} d LEFT JOIN {x_dim_dataset} USING (datasetcode, datasetversion)
  LEFT JOIN {x_serving_dim} v ON (v.iddataset, v.datasetversion) = (d.iddataset, d.datasetversion) GROUP BY tenantcode
), multi AS (SELECT tenantcode, count(*) FILTER (dominio = 'MULTI' AND codice_dataset IS NOT NULL) AS n FROM {o_list} GROUP BY tenantcode)
SELECT DISTINCT tenantcode, tenantname, datadisattivazione, coalesce(dataset, 0) AS dataset, nullif(n, 0) AS dataset_multi,
  CAST(coalesce(num_rows, 0) AS bigint) AS num_records_hdfs, last_seen AS last_update_speedlayer
FROM {x_tenant} LEFT JOIN facts USING (tenantcode) LEFT JOIN multi USING (tenantcode)
""")

# ---------------------------------------------------------------- frames of the governance jobs


_SOURCE_NAMES = {
    "tenants": "x_tenant", "datasets": "x_dataset", "streams": "x_stream", "serving_dim": "x_serving_dim", "dataset_sizes": "x_dim_dataset",
    "catalog": "x_catalog", "owners": "x_owner", "space_lines": "x_space", "stage_lines": "x_stage", "calls": "x_calls", "register": "x_register",
}
_LOADS = ("2024-01-01 02:00:00", "2024-01-02 02:00:00")


# what the governance sources take of a line; nearly all of them join or group lines and orders by the order's number
_LINE = "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice l_returnflag l_linestatus l_shipdate"

_CARD = "info_tenant_completo"  # written where more is joined to it: a task that sorts for all the joins at once runs out of memory


class Governance:
    """The governance marts over one set of inputs.

    ``whole``: for marts that need most of the sources. Lines and orders are then dealt out by order once, and what several
    marts need of the dataset versions is written down. So are the marts in ``written``.
    """

    def __init__(self, t: Inputs, *written: str, whole: bool = False):
        self.t, self.root = t, scratch_path(t.spark, "marts")
        self.marts = marts.governance_marts(YEAR, OWN_DATABASES, SERVING_ROOT)
        self.mart = marts.planned(self.marts, self.source, [marts.RECORDS, *written] if whole else written)
        if whole:
            t.kept("lineitem", "l_orderkey", columns=_LINE)
            t.kept("orders", "o_orderkey")

    def source(self, name: str) -> DataFrame:
        return self.t(_SOURCE_NAMES[name])

    def load(self, load_time: str, *wanted: str) -> marts.Frames:
        return marts.load_marts(self.t.spark, self.marts, self.source, self.root, load_time, self.prefix(), wanted or None)

    def prefix(self) -> str:
        return f"g{self.root[-32:]}_"

    def report(self, name: str) -> DataFrame:
        """A report, written and read back, nulls being empty text."""
        written = marts.export_reports(self.mart, f"{self.root}/reports", _LOADS[1], [name])
        reader = self.t.spark.read.option("header", True).option("sep", ";").option("escape", '"').option("multiLine", True)
        return reader.csv(written[name]).fillna("")


@query("tenant_info", TENANT_INFO)
def tenant_info(t: Inputs) -> DataFrame:
    return governance.tenant_info(t("x_tenant"), t("x_dataset"), t("x_serving_dim"))


@query("catalog_sizes_flagged", TABLE_SIZES)
def catalog_sizes_flagged(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "mart")
    return save_table(Governance(t).mart("info_dim_hive_table_tenant"), f"table_sizes_{path[-32:]}", path)


@query("size_mb_by_tenant", LAKE_MB)
def size_mb_by_tenant(t: Inputs) -> DataFrame:
    return governance.lake_mb(t("x_tenant"), catalog.table_sizes(t("x_catalog"), t("x_dataset"), t("x_owner"), OWN_DATABASES))


@query("csv_size_by_tenant", CSV_MB)
def csv_size_by_tenant(t: Inputs) -> DataFrame:
    return governance.csv_mb(t("x_tenant"), t("x_dataset"), t("x_dim_dataset"))


@query("binary_size", BINARY_MB)
def binary_size(t: Inputs) -> DataFrame:
    return governance.binary_mb(t("x_tenant"), t("x_dataset"), t("x_dim_dataset"))


@query("collection_bytes", COLLECTION_BYTES)
def collection_bytes(t: Inputs) -> DataFrame:
    return space.collection_bytes(t("x_dataset"), parse_collection_listing(t("x_space"), SERVING_ROOT))


@query("prorated_size", SERVING_MB)
def prorated_size(t: Inputs) -> DataFrame:
    return governance.serving_mb(t("x_tenant"), t("x_dataset"), t("x_serving_dim"), Governance(t).mart("solr_tot_bytes"))


@query("stage_bytes", STAGE_BYTES)
def stage_bytes(t: Inputs) -> DataFrame:
    return parse_stage_listing(t("x_stage"))


@query("stage_size_by_tenant", STAGE_MB)
def stage_size_by_tenant(t: Inputs) -> DataFrame:
    return governance.stage_mb(t("x_tenant"), parse_stage_listing(t("x_stage")))


@query("distinct_counts", OBJECT_COUNTS)
def distinct_counts(t: Inputs) -> DataFrame:
    return governance.object_counts(t("x_tenant"), t("x_stream"))


_TOTAL = 'CAST(round("dimTotale" * 10) AS bigint) AS tenths'


@query("tenant_sizes_total", f'SELECT * EXCLUDE ("dimTotale"), {_TOTAL} FROM {{o_card}}')
def tenant_sizes_total(t: Inputs) -> DataFrame:
    card = Governance(t, whole=True).mart("info_tenant_completo")
    return card.withColumn("tenths", F.round(F.col("dimTotale") * 10).cast("bigint")).drop("dimTotale")


@query("calls_monthly", "SELECT * REPLACE (CAST(ultima_chiamata AS string) AS ultima_chiamata) FROM {o_monthly}")
def calls_monthly(t: Inputs) -> DataFrame:
    return plain_types(governance.calls_monthly(t("x_calls")))


@query("calls_yearly_avg", "SELECT * REPLACE (CAST(ultima_chiamata AS string) AS ultima_chiamata) FROM {o_calls}")
def calls_yearly_avg(t: Inputs) -> DataFrame:
    return plain_types(Governance(t).mart("info_chiamate_mese"))


@query("yearly_calls", f"SELECT DISTINCT tenantcode, media_chiamate_anno AS odata FROM {{o_calls}} WHERE anno = {YEAR}")
def yearly_calls(t: Inputs) -> DataFrame:
    return governance.calls_of_year(Governance(t).mart("info_chiamate_mese"), YEAR)


@query("dataset_list", DATASET_LIST)
def dataset_list(t: Inputs) -> DataFrame:
    return governance.dataset_list(t("x_tenant"), t("x_dataset"))


@query("ordered_list", DATASET_LIST)
def ordered_list(t: Inputs) -> DataFrame:
    return reports.report_datasets(governance.dataset_list(t("x_tenant"), t("x_dataset")))


@query("usage_register", f'SELECT * EXCLUDE ("dimTotale"), {_TOTAL} FROM {{o_usage}}')
def usage_register(t: Inputs) -> DataFrame:
    usage = Governance(t, _CARD, whole=True).mart("info_registro_fruizione")
    return usage.withColumn("tenths", F.round(F.col("dimTotale") * 10).cast("bigint")).drop("dimTotale")


@query(
    "records_by_tenant",
    "SELECT * REPLACE (CAST(last_update_speedlayer AS string) AS last_update_speedlayer) FROM {o_records}",
)
def records_by_tenant(t: Inputs) -> DataFrame:
    return plain_types(Governance(t).mart("info_dim_dataset_tenant"))


# ---------------------------------------------------------------- reports


def _number(name: str, scale: int):
    """A decimal-comma text as a whole number of the given fraction, so that both engines compare exactly."""
    value = F.translate(F.nullif(F.col(name), F.lit("")), ",", ".").cast("double")
    return F.round(value * scale).cast("bigint").alias(name)


def _text(*names: str) -> str:
    return ", ".join(f"coalesce(CAST({name} AS string), '') AS {name}" for name in names)


@query(
    "report_register",
    f"""SELECT {_text(*'idecosystem ecosistema ente_pagante ente_titolare incaricato_trattamento progetto tenantname tenantcode tenanttype referente email_referente dataultimoaggiornamento dataattivazione datadisattivazione in_consuntivo pagante num_smartobjects num_streams tot_so_stream modulo_data_prep modulo_data_in_out dataset note'.split())},
        CAST(round("dimTotale" * 10) AS bigint) AS "dimTotale", CAST(round(odata * 1000000) AS bigint) AS odata FROM {{o_usage}}""",
)
def report_register(t: Inputs) -> DataFrame:
    report = Governance(t, _CARD, whole=True).report("registro_di_fruizione")
    return report.withColumns({"dimTotale": _number("dimTotale", 10), "odata": _number("odata", 1_000_000)})


_SIZES = '"hive_dim_MB" "hdfs_csv_dim_MB" "bin_dim_MB" solrtenantcollmb hdfs_stage_dim'.split()


@query(
    "report_sizes",
    f"""SELECT {', '.join(f"replace(CAST({c} AS string), '.', ',') AS {c}" for c in _SIZES)},
        {_text('tenantcode', 'num_smartobjects', 'num_streams', 'tot_so_stream')},
        CAST(round("dimTotale" * 10) AS bigint) AS "dimTotale" FROM {{o_card}}""",
)
def report_sizes(t: Inputs) -> DataFrame:
    return Governance(t, whole=True).report("dimensioni_tenant").withColumn("dimTotale", _number("dimTotale", 10))


@query(
    "report_calls",
    f"""SELECT {_text('u.idecosystem', 'anno', 'mese', 'num_chiamate_mese', 'fruitori_distinti', 'in_consuntivo', 'pagante').replace('AS u.', 'AS ')},
        tenantname, CAST(round(media_al_sec * 1000000000000) AS bigint) AS media_al_sec,
        strftime(ultima_chiamata, '%Y-%m-%dT%H:%M:%S') AS ultima_chiamata
        FROM {{o_calls}} c JOIN {{o_usage}} u ON u.tenantcode = c.tenantcode WHERE tenantname <> ''""",
)
def report_calls(t: Inputs) -> DataFrame:
    report = Governance(t).report("report_chiamate")
    last = F.substring("ultima_chiamata", 1, 19)
    return report.withColumns({"media_al_sec": _number("media_al_sec", 10**12), "ultima_chiamata": last})


@query(
    "report_datasets",
    f"""SELECT {_text(*'organizzazione tenantname tenantcode datadisattivazione codice_dataset status nome_dataset descr_dataset visibilita dominio sottodominio tag'.split())}
        FROM {{o_list}}""",
)
def report_datasets(t: Inputs) -> DataFrame:
    return Governance(t).report("report_elenco_dataset")


@query(
    "report_records",
    f"""SELECT {_text('tenantname', 'datadisattivazione', 'dataset', 'dataset_multi', 'num_records_hdfs')},
        coalesce(strftime(last_update_speedlayer, '%Y-%m-%dT%H:%M:%S'), '') AS last_update_speedlayer FROM {{o_records}}""",
)
def report_records(t: Inputs) -> DataFrame:
    report = Governance(t).report("report_dim_dataset_tenant")
    return report.withColumn("last_update_speedlayer", F.substring("last_update_speedlayer", 1, 19))


# what each mart says of a tenant after the second load, read through the views; the histories hold both loads
_SAYS = {
    "info_tenant": ("o_info", "count(dataultimoaggiornamento)"),
    "info_dim_hive_table_tenant": ("o_tables", "count(*)"),
    "info_tenant_completo": ("o_card", 'CAST(round(max(dimTotale) * 10) AS bigint)'),
    "info_chiamate_mese": ("o_calls", "CAST(sum(num_chiamate_mese) AS bigint)"),
    "info_elenco_dataset": ("o_list", "CAST(sum(codice_dataset) AS bigint)"),
    "info_registro_fruizione": ("o_usage", "max(dataset)"),
    "info_dim_dataset_tenant": ("o_records", "max(num_records_hdfs)"),
}
_KEPT = {"solr_tot_bytes": ("o_bytes", "count(solr_byte)"), "area_stage_bytes": ("o_stage_bytes", "CAST(sum(CAST(byte AS bigint)) AS bigint)")}


def _told(mart: str, table: str, value: str, load: str = "NULL") -> str:
    return f"SELECT '{mart}' AS mart, {load} AS load_time, tenantcode, {value} AS value FROM {table} GROUP BY tenantcode"


@query(
    "governance_load",
    " UNION ALL ".join(
        [_told(mart, f"{{{view}}}", value) for mart, (view, value) in _SAYS.items()]
        + [_told(mart, f"{{{view}}}", value, f"'{load}'") for mart, (view, value) in _KEPT.items() for load in _LOADS]
    ),
)
def governance_load(t: Inputs) -> DataFrame:
    g = Governance(t, whole=True)
    g.load(_LOADS[0], *_KEPT)
    g.load(_LOADS[1])
    g.load(_LOADS[1])  # finds all its marts complete and changes nothing
    told = [t.spark.sql(_told(mart, g.prefix() + mart, value, "CAST(NULL AS string)")) for mart, (_, value) in _SAYS.items()]
    for mart, (_, value) in _KEPT.items():
        history = marts.history(t.spark, g.root, mart).groupBy(F.col("ts_inserimento").cast("string").alias("load_time"), "tenantcode")
        told.append(history.agg(F.expr(value).alias("value")).select(F.lit(mart).alias("mart"), "load_time", "tenantcode", "value"))
    return reduce(DataFrame.unionByName, told)


# ---------------------------------------------------------------- metadata marts

_SOURCES = (
    "tenant organization tenant_type tenant_status bundle tenant_bundle data_source status subdomain domain license "
    "tenant_data_source dataset dataset_type dataset_subtype component source_tag tag stream smart_object so_type "
    "so_category api"
).split()


def _catalogue(t: Inputs, shared: bool = False, by_source: tuple[str, ...] = ()) -> metadata.Tables:
    if shared:  # most of the tables are built from this one
        t.kept("m_data_source", *metadata.SOURCE)
    return {name: t.by_source(f"m_{name}") if name in by_source else t(f"m_{name}") for name in _SOURCES}


_ZEROS = ", ".join(f"0 AS {name}" for name in metadata.ZERO_SIZES)


@query(
    "mart_tenant",
    f"""SELECT tenantcode, t.name AS tenantname, t.id_tenant AS idtenant, t.description AS descrtenant, organizationcode,
          tenanttypecode AS tenanttype, tenantstatuscode AS coddeploymentstatus, activationdate AS dataattivazione,
          id_ecosystem AS idecosystem, username, userlastname, userfirstname, useremail, usertypeauth, {_ZEROS},
          '' AS databasenames, deactivationdate AS datadisattivazione, hasstage, zeppelin
        FROM {{m_tenant}} t, {{m_organization}} o, {{m_tenant_type}} y, {{m_tenant_status}} s, {{m_bundle}} b, {{m_tenant_bundle}} r
        WHERE o.id_organization = t.id_organization AND y.id_tenant_type = t.id_tenant_type
          AND s.id_tenant_status = t.id_tenant_status AND r.id_tenant = t.id_tenant AND r.id_bundles = b.id_bundles""",
)
def mart_tenant(t: Inputs) -> DataFrame:
    return metadata.mart_tenant(_catalogue(t))


def _list(value: str, tables: str, where: str = "true") -> str:
    return f"""SELECT id_data_source, datasourceversion, string_agg(DISTINCT {value}, ',' ORDER BY {value}) AS v
      FROM {tables} WHERE {where} GROUP BY id_data_source, datasourceversion"""


_oracle_view("o_names", _list("name", "{m_component}"))
_oracle_view("o_tags", _list("tagcode", "{m_source_tag} s JOIN {m_tag} g ON g.id_tag = s.id_tag"))
_oracle_view("o_shares", _list("tenantcode", "{m_tenant_data_source} r JOIN {m_tenant} t ON t.id_tenant = r.id_tenant", "isactive = 1"))

_LISTS = """
LEFT JOIN {o_names} names ON names.id_data_source = s.id_data_source AND names.datasourceversion = s.datasourceversion
LEFT JOIN {o_tags} tags ON tags.id_data_source = s.id_data_source AND tags.datasourceversion = s.datasourceversion
LEFT JOIN {o_shares} shares ON shares.id_data_source = s.id_data_source AND shares.datasourceversion = s.datasourceversion
"""
_MANAGED = """
JOIN {m_tenant_data_source} r ON r.id_data_source = s.id_data_source AND r.datasourceversion = s.datasourceversion
  AND r.ismanager = 1 AND r.isactive = 1
JOIN {m_tenant} t ON t.id_tenant = r.id_tenant JOIN {m_status} st ON st.id_status = s.id_status
JOIN {m_subdomain} sd ON sd.id_subdomain = s.id_subdomain JOIN {m_domain} dm ON dm.id_domain = sd.id_domain
LEFT JOIN {m_license} li ON li.id_license = s.id_license
"""


@query(
    "mart_stream",
    f"""SELECT idstream, streamcode, streamname, r.id_tenant AS idtenant, tenantcode, d.iddataset, d.datasourceversion AS datasetversion,
          so.id_smart_object AS idvirtualentity, so.id_so_category AS idcategoriave, so.id_so_type AS idtipove,
          so.name AS virtualentityname, so.description AS descrve, socode AS virtualentitycode, sotypecode AS virtualentitytype,
          socategorycode AS virtualentitycategory, statuscode AS streamstatus, domaincode AS domainstream, licensecode AS licence,
          s.visibility, 'true' AS publishstream, names.v AS elencocomponent, tags.v AS elencotag, shares.v AS elencoshare,
          slug AS virtualentityslug
        FROM {{m_stream}} x JOIN {{m_data_source}} s ON s.id_data_source = x.id_data_source AND s.datasourceversion = x.datasourceversion
        LEFT JOIN {{m_dataset}} d ON d.id_data_source = s.id_data_source AND d.datasourceversion = s.datasourceversion
        JOIN {{m_smart_object}} so ON so.id_smart_object = x.id_smart_object JOIN {{m_so_type}} sy ON sy.id_so_type = so.id_so_type
        JOIN {{m_so_category}} sc ON sc.id_so_category = so.id_so_category {_MANAGED} {_LISTS}""",
)
def mart_stream(t: Inputs) -> DataFrame:
    return metadata.mart_stream(_catalogue(t, shared=True, by_source=("source_tag", "stream")))


_DATASET_COLUMNS = """
d.iddataset, d.datasetcode, d.datasourceversion AS datasetversion, r.id_tenant AS idtenant, tenantcode, dataset_type AS tipo,
dataset_subtype AS sottotipo, d.phoenixtablename AS tabella, statuscode AS datasetstatus,
CASE WHEN s.datasourceversion = (SELECT max(z.datasourceversion) FROM {m_data_source} z WHERE z.id_data_source = s.id_data_source)
  AND statuscode = 'inst' THEN 1 ELSE 0 END AS corrente,
datasetname, d.description AS descrds, licensecode AS license, s.visibility, domaincode AS datadomain,
(SELECT max(z.iddataset) FROM {m_dataset} z WHERE z.id_data_source = d.id_data_source_binary) AS binaryiddataset,
datasourceversion_binary AS binarydatasetversion, isopendata AS openflag, opendataauthor AS openauthor, names.v AS elencocampi,
tags.v AS elencotag, shares.v AS elencoshare, subdomaincode AS codsubdomain,
CASE WHEN statuscode = 'inst' THEN 'false' ELSE 'true' END AS deleted
"""
_DATASET_FROM = f"""
FROM {{m_data_source}} s JOIN {{m_dataset}} d ON d.id_data_source = s.id_data_source AND d.datasourceversion = s.datasourceversion
JOIN {{m_dataset_type}} dt ON dt.id_dataset_type = d.id_dataset_type
JOIN {{m_dataset_subtype}} ds ON ds.id_dataset_subtype = d.id_dataset_subtype {_MANAGED} {_LISTS}
"""


@query("mart_dataset", f"SELECT {_DATASET_COLUMNS} {_DATASET_FROM}")
def mart_dataset(t: Inputs) -> DataFrame:
    return metadata.mart_dataset(_catalogue(t, shared=True, by_source=("source_tag",)))


def _default(name: str) -> str:
    return f"""coalesce(d.{name}, CASE dataset_subtype WHEN 'bulkDataset' THEN data{name} WHEN 'socialDataset' THEN social{name}
      WHEN 'streamDataset' THEN measures{name} ELSE media{name} END) AS {name}"""


@query(
    "mart_dataset_extended",
    f"""SELECT {_DATASET_COLUMNS}, {_default('solrcollectionname')}, {_default('phoenixtablename')}, {_default('phoenixschemaname')},
        dbhiveschema, dbhivetable {_DATASET_FROM} JOIN {{m_organization}} o ON o.id_organization = s.id_organization""",
)
def mart_dataset_extended(t: Inputs) -> DataFrame:
    return metadata.mart_dataset_extended(_catalogue(t, shared=True, by_source=("source_tag",)))


@query(
    "mart_api",
    """SELECT idapi, apiname, apicode, t.id_tenant, tenantcode, apitype, apisubtype, entitynamespace, iddataset, s.datasourceversion,
         idstream, streamcode, socode
       FROM {m_api} a JOIN {m_data_source} s ON s.id_data_source = a.id_data_source AND s.datasourceversion = a.datasourceversion
       LEFT JOIN {m_dataset} d ON d.id_data_source = s.id_data_source AND d.datasourceversion = s.datasourceversion
       LEFT JOIN {m_stream} x ON x.id_data_source = s.id_data_source AND x.datasourceversion = s.datasourceversion
       LEFT JOIN {m_smart_object} so ON so.id_smart_object = x.id_smart_object
       JOIN {m_tenant_data_source} r ON r.id_data_source = s.id_data_source AND r.datasourceversion = s.datasourceversion
       JOIN {m_tenant} t ON t.id_tenant = r.id_tenant""",
)
def mart_api(t: Inputs) -> DataFrame:
    return metadata.mart_api(_catalogue(t, shared=True))



@query(
    "snapshot_history",
    " UNION ALL ".join(
        [f"SELECT tenantcode, tenantname, organizationcode, '{ts}' AS ts_inserimento, 'history' AS kept FROM {{x_tenant}}" for ts in _LOADS]
        + ["SELECT tenantcode, tenantname, organizationcode, NULL, 'current' FROM {x_tenant}"]
    ),
)
def snapshot_history(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "snapshot")
    rows = t("x_tenant").select("tenantcode", "tenantname", "organizationcode")
    for load_time in _LOADS:
        snapshot(rows, path, load_time)
    history = plain_types(t.spark.read.orc(f"{path}/history")).withColumn("kept", F.lit("history"))
    current = t.spark.read.orc(f"{path}/current").withColumn("kept", F.lit("current"))
    return history.unionByName(current, allowMissingColumns=True)
