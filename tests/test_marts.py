import pytest
from pyspark.sql import functions as F

from tidemark.plans import catalog, governance, selectors, space
from tidemark.plans.descriptors import descriptors, serving_names
from tidemark.plans.reports import report_sizes
from tidemark.sources.documents import live_documents, publishable_documents, tenant_collections
from tidemark.sources.listing import parse_collection_listing


@pytest.fixture(scope="module")
def world(spark):
    tenant = "tenantcode string, tenantname string, organizationcode string, idecosystem string, tenanttype string, coddeploymentstatus string, userlastname string, userfirstname string, useremail string, zeppelin string, hasstage string, dataattivazione string, datadisattivazione string"
    people = ("o", "e", "ty", "st", "Last", "First", "m@x", "undefined", "yes", "undefined", "d")
    tenants = spark.createDataFrame([("t1", "One", *people), ("t2", "Two", *people), ("t3", "None", *people)], tenant)
    datasets = spark.createDataFrame(
        [
            (1, 9, "ds_1", "t1", "inst", "c1", 12, 1, "DB_A", "tab1", "MULTI", "a\nb"),
            (1, 10, "ds_1", "t1", "inst", "c1", 12, 1, "DB_A", "TAB1", "MULTI", "c\nd"),
            (2, 1, "ds_2", "t2", "req", "c1", None, None, "db_a", "tab2", "x", None),
            (112, 1, "ds_112", "t2", "inst", "c2", 12, 1, "db_a", "tab3", "x", ""),
        ],
        "iddataset int, datasetversion int, datasetcode string, tenantcode string, datasetstatus string, solrcollectionname string, binaryiddataset int, binarydatasetversion int, dbhiveschema string, dbhivetable string, datadomain string, descrds string",
    ).withColumns({"visibility": F.lit("public"), "codsubdomain": F.lit(""), "elencotag": F.lit("t")})
    sizes = spark.createDataFrame(
        [("ds_1", 9, 1048576, 5), ("ds_1", 10, 2097152, 6), ("ds_12", 1, 524288, 1), ("ds_112", 1, 10485760, 2)],
        "datasetcode string, datasetversion int, num_bytes bigint, num_rows bigint",
    )
    serving = spark.sql("""SELECT * FROM VALUES (1, 9, 30L, timestamp'1970-01-01 00:30:00'), (1, 10, 0L, timestamp'1970-01-01 01:00:00'),
      (2, 1, 10L, timestamp'2020-05-06 07:08:09'), (112, 1, 0L, NULL) AS t(iddataset, datasetversion, numrecord, lasttimeid)""")
    return tenants, datasets, sizes, serving


def test_tenant_info_epoch_and_undefined(rows, world):
    tenants, datasets, _, serving = world
    found = rows(governance.tenant_info(tenants, datasets, serving), "tenantcode", "referente", "dataultimoaggiornamento", "zeppelin", "stage", "dataattivazione")
    assert found == [(f"t{i}", "Last First", last, "", "yes", "") for i, last in ((1, None), (2, "2020-05-06"), (3, None))]
    assert governance.repeated_tenants(tenants.unionByName(tenants.limit(1))).count() == 1


def test_sizes_per_tenant(spark, rows, world):
    tenants, datasets, sizes, serving = world
    assert rows(governance.csv_mb(tenants, datasets, sizes)) == [("t1", 3.0), ("t2", 10.0), ("t3", 0.0)]
    assert rows(governance.binary_mb(tenants, datasets, sizes)) == [("t1", 0.5), ("t2", 0.5), ("t3", 0.0)]
    stage = spark.createDataFrame([("1048576", "p", "t1"), ("bad", "p", "t1"), ("7", "p", "zz")], "byte string, stg_path string, tenantcode string")
    assert rows(governance.stage_mb(tenants, stage)) == [("t1", 1.0), ("t2", 0.0), ("t3", 0.0)]


def test_serving_share_with_a_zero_total(spark, rows, world):
    tenants, datasets, _, serving = world
    lines = spark.createDataFrame([("4194304  /serving/C1",), ("100 /serving/c2",), ("x /serving/c9",)], "line string")
    collections = space.collection_bytes(datasets, parse_collection_listing(lines, "/serving"))
    assert rows(collections) == [("t1", 4194304.0, "c1"), ("t2", 100.0, "c2"), ("t2", 4194304.0, "c1")]
    # c1 is shared 30:10; c2 has no records, so that share is unknown and does not count
    assert rows(governance.serving_mb(tenants, datasets, serving, collections)) == [("t1", 3.0), ("t2", 1.0), ("t3", 0.0)]
    only = datasets.where("iddataset = 112")
    assert rows(governance.serving_mb(tenants, only, serving, collections)) == [("t1", 0.0), ("t2", None), ("t3", 0.0)]


def test_card_total_is_null_when_a_size_is(spark, rows, world):
    tenants, datasets, sizes, serving = world
    codes = tenants.select(F.col("tenantcode").alias("tenant"))

    def part(name, value):
        return codes.withColumn(name, value)

    streams = spark.createDataFrame([("t1", 1, 1), ("t1", 1, 2), ("t1", None, 3)], "tenantcode string, idvirtualentity int, idstream int")
    objects = governance.object_counts(tenants, streams)
    assert rows(objects) == [("t1", 1, 3, 4), ("t2", 0, 0, 0), ("t3", 0, 0, 0)]
    unknown = F.when(F.col("tenant") != "t2", F.lit(1.5))
    card = governance.tenant_card(
        governance.tenant_info(tenants, datasets, serving), part("hive_dim_MB", F.lit(1.0)), part("hdfs_csv_dim_MB", F.lit(1.0)),
        part("bin_dim_MB", F.lit(1.0)), part("solrtenantcollmb", unknown), part("hdfs_stage_dim", F.lit(1.0)), objects,
    )
    assert rows(card, "tenantcode", "dimTotale") == [("t1", 5.5), ("t2", None), ("t3", 5.5)]
    assert rows(report_sizes(card), "tenantcode", "dimTotale", "solrtenantcollmb")[0] == ("t1", "5,5", "1,5")


def test_dataset_list_uses_numeric_versions(rows, world):
    tenants, datasets, sizes, serving = world
    listed = governance.dataset_list(tenants, datasets)
    assert rows(listed, "codice_dataset", "descr_dataset") == [(1, "c d"), (112, ""), (2, None)]
    records = governance.records_by_tenant(tenants, datasets, sizes, serving, listed)
    assert rows(records, "tenantname", "dataset", "dataset_multi", "num_records_hdfs") == [
        ("None", 0, None, 0), ("One", 1, 1, 11), ("Two", 2, None, 2)
    ]


def test_calls(spark, rows, world):
    tenants, datasets, _, serving = world
    calls = spark.createDataFrame(
        [("t1", 2020, 1, 2592000, 3, "b"), ("t1", 2020, 1, 2592000, 5, "a"), ("t1", 2020, 2, 1, 1, "c"), ("zz", 2020, 1, 9, 9, "z")],
        "tenant string, year int, month int, num_chiamate_mese bigint, fruitori_distinti_tenant int, ultima_chiamata string",
    )
    monthly = governance.calls_monthly(calls)
    assert rows(monthly.where("mese = 1 AND tenantcode = 't1'"), "num_chiamate_mese", "fruitori_distinti", "media_al_sec", "ultima_chiamata") == [(5184000, 5, 2.0, "b")]
    full = governance.calls(monthly, governance.tenant_info(tenants, datasets, serving))
    assert rows(full, "tenantcode", "mese", "media_chiamate_anno") == [("t1", 1, 2592000.5), ("t1", 2, 2592000.5)]
    assert rows(governance.calls_of_year(full, 2020)) == [("t1", 2592000.5)] and governance.calls_of_year(full, 2021).count() == 0


def test_table_owners(spark, rows, world):
    _, datasets, *_ = world
    tables = spark.createDataFrame(
        [("db_a", "TAB1", "10", "1"), ("db_a", "tab2", "20", "1"), ("db_a", "db_catalog_x", "5", "1"), ("db_log", "t", "5", "1"), ("dbxa", "t", "6", "1"), ("hr", "t", "7", "1")],
        "db_name string, tbl_name string, total_size string, num_rows string",
    )
    owners = spark.createDataFrame([("t8", "db_a"), ("t9", "db_a")], "tenantcode string, db_hive string")
    both = catalog.table_sizes(tables, datasets, owners, ["db_log"])
    assert rows(both, "tenantcode", "dbname", "tbl_name", "flag_approx") == [
        ("t1", "db_a", "TAB1", "0"), ("t8", "db_a", "tab2", "1"), ("t9", "db_a", "tab2", "1"), (None, "dbxa", "t", "1")
    ]
    parts = catalog.owned_tables(tables, datasets, ["db_log"]).unionByName(catalog.unowned_tables(tables, datasets, owners, ["db_log"]))
    assert rows(both) == rows(parts)


def test_name_patterns(spark):
    df = spark.createDataFrame([("aa",), ("ab",), ("b",)], "n string")
    counts = [df.where(catalog.name_matches(F.col("n"), w)).count() for w in ("", "%", "a%", "aa, b", "ab")]
    assert counts == [3, 3, 2, 2, 1]


CHOICE = "iddataset int, datasetversion int, datasetcode string, tenantcode string, organizationcode string, sottotipo string, datasetstatus_desc string, availablespeed boolean, jdbcdburl string, jdbcdbtype string, istransformed boolean, idsubtype int, idstatus int, datadomain string, codsubdomain string"


@pytest.fixture(scope="module")
def choices(spark):
    return spark.createDataFrame(
        [
            (1, 1, "d1", "t1", "o1", "bulkDataset", "installed", True, "datalake", "HIVE", True, 1, 2, "dom", None),
            (2, 1, "d2", "t1", "o1", "streamDataset", "installed", False, "datalake", "HIVE", True, 2, 2, "dom", ""),
            (3, 1, "d3", "t2", "o2", "binaryDataset", "installed", True, None, None, None, 3, 2, "dom", "s"),
            (4, 1, "d4", "t2", "o2", "socialDataset", "requested", True, "x", "HIVE", True, 2, 5, "dom", "s"),
        ],
        CHOICE,
    )


def test_selectors(spark, rows, choices):
    def ids(df):
        return [r[0] for r in rows(df, "iddataset")]

    assert ids(selectors.by_tenant(choices)) == [1]
    assert ids(selectors.by_tenant(choices, spark.createDataFrame([("t2",)], "tenantcode string"))) == []
    assert ids(selectors.exportable(choices)) == [1, 2] and ids(selectors.compactable(choices)) == [2, 4]
    assert ids(selectors.compactable(choices, organizations=spark.createDataFrame([("o2",)], "organizationcode string"))) == [4]
    assert ids(selectors.promotable(choices).where("eligible")) == [1, 2]
    wanted = spark.createDataFrame([(1,), (3,)], "iddataset int")
    with pytest.raises(selectors.NotEligible, match="3"):
        selectors.require_eligible(selectors.by_id(choices, wanted))
    assert ids(selectors.require_eligible(selectors.by_id(choices, wanted.limit(1)))) == [1]
    members = spark.createDataFrame([(7, 1, i) for i in (1, 2, 3, 4)], "idgroup int, groupversion int, iddataset int")
    assert ids(selectors.by_group(choices, members, to_lake=True, to_serving=False)) == [1, 2]
    assert ids(selectors.by_group(choices, members, to_lake=False, to_serving=True)) == [1]
    with pytest.raises(ValueError):
        selectors.by_group(choices, members, False, False)


def test_descriptors(spark, rows, choices):
    components = spark.createDataFrame([(2, 1, 2, "B", "int"), (2, 1, 1, "A", "dateTime")], "iddataset int, datasetversion int, position int, name string, datatype string")
    streams = spark.createDataFrame([(2, 1, "st", "my slug"), (1, 1, "no", "no")], "iddataset int, datasetversion int, streamcode string, slug string")
    found = descriptors(choices, components, streams).where("iddataset <= 2")
    assert rows(found.select("iddataset", serving_names().alias("n"), "streamcode", "slug", "codsubdomain", "folder")) == [
        (1, None, None, None, "dom", "/datalake/O1/rawdata/DOM/db_DOM/d1"),
        (2, "a_dt,b_i", "st", "my-slug", "dom", "/datalake/O1/rawdata/DOM/so_my-slug/st"),
    ]


def test_documents(spark, rows):
    df = spark.createDataFrame(
        [(1, True, ("bulkDataset", "t", 1, None)), (2, True, ("bulkDataset", "t", 1, 0)), (3, True, ("bulkDataset", "t", 1, 1)),
         (4, True, ("binaryDataset", "t", 1, 0)), (5, False, ("bulkDataset", "t", 1, 0)), (6, True, ("bulkDataset", "t", 0, 0))],
        "idDataset int, availableSpeed boolean, configData struct<subtype:string,tenantCode:string,current:int,deleted:int>",
    )
    assert rows(live_documents(df), "idDataset") == [(1,), (2,), (5,), (6,)]
    assert rows(publishable_documents(df), "idDataset") == [(1,), (2,)]
    tenants = spark.createDataFrame([("t", "o", "d", "m", "s", "x", 1)], "tenantCode string, organizationCode string, dataSolrCollectionName string, measuresSolrCollectionName string, socialSolrCollectionName string, mediaSolrCollectionName string, other int")
    assert rows(tenant_collections(tenants)) == [("t", "o", "d", "m", "s", "x")]
