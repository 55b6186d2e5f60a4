"""What the catalogue's marts deal out: each relation once, and data sources never by their number alone."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401
from harness import views
from harness.registry import QUERIES
from tidemark.plans import metadata

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def shuffles(spark, name: str, keys: str) -> int:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    found = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    return found.count(keys)


@needs_data
@pytest.mark.parametrize("name", ["mart_stream", "mart_dataset", "mart_dataset_extended"])
def test_relations_meet_tenants_once(spark, name):
    assert shuffles(spark, name, "id_tenant") == 2 and shuffles(spark, name, "id_data_source, datasourceversion, id_tag") == 0


@needs_data
@pytest.mark.parametrize("name", ["mart_dataset", "mart_dataset_extended"])
def test_data_sources_are_not_dealt_out_by_number(spark, name):
    assert shuffles(spark, name, "id_data_source") == 2  # the newest versions and the attachments, grouped


@needs_data
def test_streams_are_dealt_out_once(spark):
    assert shuffles(spark, "mart_stream", "l_linestatus, l_orderkey, l_linenumber") == 0


@needs_data
@pytest.mark.parametrize("name", sorted(views.BY_SOURCE))
def test_laid_out_views_have_the_rows_of_their_text(spark, rows, tmp_path, name):
    for table in ("lineitem", "part"):
        whole = spark.read.parquet(f"{SF}/{table}.parquet").limit(300)
        odd = whole.limit(40).select(*[F.when(F.hash(F.lit(i), *whole.columns) % 3 != 0, F.col(c)).alias(c) for i, c in enumerate(whole.columns)])
        whole.unionByName(whole.limit(50)).unionByName(odd).write.parquet(f"{tmp_path}/{table}.parquet")
    t = views.Inputs(spark, str(tmp_path))
    found, wanted = t.by_source(name), t(f"{name}")
    assert found.schema.simpleString() == wanted.schema.simpleString() and rows(found) == rows(wanted) and found.count() > 50


def test_managers_and_the_newest_version(spark, rows):
    def table(schema, *values):
        return spark.createDataFrame(list(values), schema)

    source = "id_data_source int, datasourceversion int"
    src = {
        "tenant": table("id_tenant int, tenantcode string", (1, "t1"), (2, "t2"), (2, "t2b"), (3, None)),
        "tenant_data_source": table(f"{source}, id_tenant int, ismanager int, isactive int", (1, 1, 1, 1, 1), (1, 1, 2, 0, 1), (1, 2, 2, 1, 1), (1, 2, 1, 0, 0),
                                    (2, 1, 1, 0, 1), (3, 1, 1, 1, 0), (4, 1, 3, 1, 1), (None, 1, 1, 1, 1), (5, 1, 1, 1, 1), (5, 1, 1, 1, 1)),
        "data_source": table(f"{source}, id_status int", (1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1), (4, None, 1), (None, 1, 1), (5, 1, 1)),
        "component": table(f"{source}, name string", (1, 1, "b"), (1, 1, "a"), (1, 1, "a"), (4, 1, None)),
        "source_tag": table(f"{source}, id_tag int", (1, 1, 7), (1, 1, 8)), "tag": table("id_tag int, tagcode string", (7, "y"), (8, "x")),
    }
    found = metadata._managed_sources(src, "names")
    assert rows(found, "id_data_source", "datasourceversion", "idtenant", "tenantcode", "names", "elencotag", "elencoshare") == [
        (1, 1, 1, "t1", "a,b", "x,y", "t1,t2,t2b"), (1, 2, 2, "t2", None, None, "t2,t2b"), (1, 2, 2, "t2b", None, None, "t2,t2b"),
        (4, 1, 3, None, "", None, ""), (5, 1, 1, "t1", None, None, "t1"), (5, 1, 1, "t1", None, None, "t1"),
    ]
