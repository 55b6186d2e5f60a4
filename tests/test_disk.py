"""What the governance marts deal out and leave on disk: equal work is done once, and wide rows stay where they are."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from harness import queries_marts, views
from harness.registry import QUERIES
from tidemark.operators.latest import latest_versions
from tidemark.plans import governance, marts
from tidemark.session import bucketed

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture()
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark) -> int:
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return sum(blocks.apply(i).name().startswith("shuffle_") for i in range(blocks.size()))


def test_written_copies_leave_no_shuffles(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("k")).groupBy("k").count()
    before = shuffle_files(spark)
    copy = bucketed(rows, "copy", "k")
    assert shuffle_files(spark) <= before and copy.count() == 50


def test_newest_versions_leave_bucketed_rows_where_they_are(spark, rows, unbroadcast):
    df = spark.createDataFrame([(1, 9, "a"), (1, 10, "b"), (2, 1, "c"), (2, 1, "d"), (None, 3, "e"), (3, None, "f"), (None, None, "g")], "id int, v int, x string")
    newest = latest_versions(bucketed(df, "versions", "id", "v"), "id", "v")
    assert not re.search(r"Exchange hashpartitioning\((?!_?key#|_key#|id#\d+, \d+)", plan(newest)) and plan(newest).count("Exchange") <= 2
    assert rows(newest, "x") == [("b",), ("c",), ("d",)]


@pytest.fixture()
def facts(spark):
    datasets = spark.createDataFrame(
        [(1, 1, "t1", "c1", "d1"), (1, 1, "t1", "c1", "d1"), (1, 2, "t1", "c2", "d1"), (2, 1, "t2", "c1", "d2"), (3, 1, "t2", None, None), (None, 1, "t3", "c1", "d9"), (4, 1, None, "c2", "d4")],
        "iddataset int, datasetversion int, tenantcode string, solrcollectionname string, datasetcode string",
    )
    serving = spark.sql("""SELECT * FROM VALUES (1, 1, 5L, timestamp'2020-01-02 00:00:00'), (1, 1, 7L, timestamp'2020-03-02 00:00:00'), (2, 1, 4L, NULL),
      (3, 1, 1L, timestamp'2021-01-01 00:00:00'), (CAST(NULL AS int), 1, 9L, timestamp'2022-01-01 00:00:00') AS t(iddataset, datasetversion, numrecord, lasttimeid)""")
    tenants = spark.createDataFrame([(f"t{i}", *["x"] * 12) for i in (1, 2, 3, 4)], ", ".join(f"{c} string" for c in ["tenantcode", *[k for k in governance.TENANT_KEYS if k != "tenantcode"]]))
    return tenants, datasets, serving


def test_written_records_say_the_same(spark, rows, facts):
    tenants, datasets, serving = facts
    records = governance.collection_records(datasets, serving)
    assert rows(records.select("tenantcode", "solrcollectionname", "numrecord")) == [
        ("t1", "c1", 24), ("t1", "c2", None), ("t2", "c1", 4), ("t2", None, 1), ("t3", "c1", None), (None, "c2", None)
    ]
    assert rows(governance.tenant_info(tenants, datasets, serving, records)) == rows(governance.tenant_info(tenants, datasets, serving))
    assert rows(governance.tenant_info(tenants, datasets, serving, records), "dataultimoaggiornamento") == [("2020-03-02",), ("2021-01-01",), (None,), (None,)]
    collections = datasets.select("tenantcode", F.lit(1048576.0 * 28).alias("solr_byte"), "solrcollectionname").distinct()
    assert rows(governance.serving_mb(tenants, datasets, serving, collections, records)) == [("t1", 24.0), ("t2", 4.0), ("t3", 0.0), ("t4", 0.0)]


def test_records_of_repeated_serving_keys(spark, rows, facts):
    tenants, datasets, serving = facts
    sizes = spark.createDataFrame([("d1", 1, 10), ("d2", 1, 3)], "datasetcode string, datasetversion int, num_rows bigint")
    listed = spark.createDataFrame([(1, "t1", "MULTI")], "codice_dataset int, tenantcode string, dominio string")
    found = governance.records_by_tenant(tenants, datasets, sizes, serving, listed)
    assert rows(found, "tenantcode", "dataset", "num_records_hdfs") == [("t1", 1, 40), ("t2", 2, 3), ("t3", 0, 0), ("t4", 0, 0)]


@needs_data
def test_lines_and_orders_are_dealt_out_once(spark, unbroadcast):
    found = plan(QUERIES["tenant_sizes_total"](spark, SF))
    assert not re.search(r"hashpartitioning\((l|o)_orderkey#", found) and "lasttimeid" in found and "max(l_shipdate" not in found


@needs_data
def test_register_sorts_for_few_joins_at_once(spark, unbroadcast):
    found = plan(QUERIES["usage_register"](spark, SF))
    assert not re.search(r"hashpartitioning\((l|o)_orderkey#", found) and "idvirtualentity" not in found


@needs_data
@pytest.mark.parametrize("report", ["registro_di_fruizione", "dimensioni_tenant"])
def test_reports_use_the_same_copies(spark, unbroadcast, report):
    g = queries_marts.Governance(views.Inputs(spark, SF), whole=True)
    assert not re.search(r"hashpartitioning\((l|o)_orderkey#", plan(marts.REPORTS[report](g.mart)))


def test_a_load_leaves_no_shuffles_of_its_marts(spark, tmp_path):
    listed = [marts.Mart("a", lambda f: f("src").groupBy("k").count(), keys=("k",)), marts.Mart("b", lambda f: f("src").groupBy("k").count())]
    source, before = spark.range(1000).select((F.col("id") % 50).alias("k")), shuffle_files(spark)
    frames = marts.load_marts(spark, listed, lambda _: source, str(tmp_path), "2024", f"disk{os.getpid()}_", buckets=2)
    try:
        assert shuffle_files(spark) <= before and frames("a").count() == frames("b").count() == 50
    finally:
        for name in ("a", "b"):
            spark.sql(f"DROP VIEW IF EXISTS disk{os.getpid()}_{name}")
            spark.sql(f"DROP TABLE IF EXISTS disk{os.getpid()}_{name}__2024")
