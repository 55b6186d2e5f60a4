import pytest
from pyspark.sql import functions as F

from tidemark.functions.objectid import NEVER_ID
from tidemark.plans.jobs import export_datasets, incremental_datasets, promote_datasets, publish_datasets
from tidemark.plans.state import TENANT_KEYS, TENANT_SCHEMA, last_ids, merge_state, state_table
from tidemark.sources.csv_files import read_raw_csv
from tidemark.sources.serving import read_collection

DESCRIBED = (
    "iddataset bigint, datasetversion bigint, datasetcode string, family string, "
    "campi array<struct<fieldName:string,dataType:string>>, dbhiveschema string, dbhivetable string, "
    "solrcollectionname string, folder string, jdbcdbhive string, jdbctablename string"
)


@pytest.fixture
def chosen(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS src")
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    for number, size in ((1, 3), (2, 5), (3, 2)):
        table = spark.range(size).select(
            F.col("id").cast("int").alias("num"), F.lit("2020-01-02 03:04:05").cast("timestamp").alias("seen"),
            F.concat(F.lit("r"), "id").alias("extra"), F.lit("s").alias("bda_sensor"),
            F.lit("2020-01-02 03:04:05").cast("timestamp").alias("bda_time"), F.lit("c").alias("bda_streamcode"),
        )
        table.write.mode("overwrite").saveAsTable(f"src.t{number}")
    short, long = [("Num", "int"), ("seen", "date")], [("Num", "int"), ("seen", "date"), ("extra", "string")]
    rows = [
        (i, 1, f"ds{i}", "data", fields, "lake", f"t{i}", f"coll{i % 2}", f"{tmp_path}/out/ds{i}", "src", f"t{i}")
        for i, fields in ((1, short), (2, long), (3, short))
    ]
    return spark.createDataFrame(rows, DESCRIBED)


def test_promote_publish_and_export(spark, rows, chosen, tmp_path):
    stats = str(tmp_path / "stats")
    done = promote_datasets(spark, chosen, "2020-01-01 00:00:00", stats)
    assert done == {"lake.t1": 3, "lake.t2": 5, "lake.t3": 2}

    state = state_table(spark, str(tmp_path / "state"))
    reports = publish_datasets(spark, chosen, lambda name: str(tmp_path / name), state=state, stats_path=stats)
    assert sorted(tuple(r) for report in reports for r in report.select("iddataset_l", "record_write").collect()) == [(1, 3), (2, 5), (3, 2)]
    odd = read_collection(spark, str(tmp_path / "coll1"))
    assert set(odd.columns) == {"id", "iddataset_l", "datasetversion_l", "origin_s", "num_i", "seen_dt"} and odd.count() == 5
    assert dict(odd.dtypes)["seen_dt"] == "date"
    assert rows(state.read()) == [(1, 1, NEVER_ID), (2, 1, NEVER_ID), (3, 1, NEVER_ID)]

    files = export_datasets(spark, chosen, state, "overwrite", "a" * 24, stats_path=stats)
    assert sorted(f.rsplit("/", 1)[1] for f in files) == [f"{'a' * 24}_{n}-ds{i}-1.csv" for i, n in ((3, 2), (1, 3), (2, 5))]
    found = read_raw_csv(spark, str(tmp_path / "out" / "ds2"), ["num", "seen", "extra"])
    assert ("4", "2020-01-02T03:04:05.000Z", "r4") in rows(found)
    assert rows(spark.read.orc(stats).groupBy("job").agg(F.sum("record_read"), F.sum("record_write"))) == [
        ("export", 10, 10), ("promote", 10, 10), ("publish", 10, 10)
    ]


@pytest.mark.parametrize("tables", [1, 50])
def test_result_does_not_depend_on_plans_versions_or_emptiness(spark, rows, chosen, tmp_path, tables):
    """Two versions with different fields share a folder and a collection; one dataset has become empty."""
    promote_datasets(spark, chosen, "2020-01-01 00:00:00")
    one = chosen.where("iddataset = 1").withColumn("solrcollectionname", F.lit("c")).withColumn("folder", F.lit(f"{tmp_path}/out/ds1"))
    again = chosen.where("iddataset = 2").select(F.lit(1).cast("bigint").alias("iddataset"), F.lit(2).cast("bigint").alias("datasetversion"), F.lit("ds1").alias("datasetcode"), *chosen.columns[3:7], F.lit("c").alias("solrcollectionname"), F.lit(f"{tmp_path}/out/ds1").alias("folder"), "jdbcdbhive", "jdbctablename")
    gone = chosen.where("iddataset = 3").withColumn("solrcollectionname", F.lit("c"))
    every = one.unionByName(again).unionByName(gone)
    state, path = state_table(spark, str(tmp_path / "state")), lambda name: str(tmp_path / name)
    for run in ("a" * 24, "b" * 24):
        if run[0] == "b":
            spark.table("lake.t3").limit(0).write.mode("overwrite").saveAsTable("lake.t3_empty")
            every = every.withColumn("dbhivetable", F.when(F.col("iddataset") == 3, "t3_empty").otherwise(F.col("dbhivetable")))
        reports = publish_datasets(spark, every, path, state=state, tables_per_plan=tables)
        export_datasets(spark, every, state, "overwrite", run, tables_per_plan=tables)
    assert rows(read_collection(spark, path("c")).groupBy("iddataset_l", "datasetversion_l").count()) == [(1, 1, 3), (1, 2, 5)]
    found = [tuple(r) for report in reports for r in report.select("iddataset_l", "datasetversion_l", "record_read", "record_write").collect()]
    assert sorted(found) == [(1, 1, 3, 3), (1, 2, 5, 5), (3, 1, 0, 0)]
    assert sorted(p.name for p in (tmp_path / "out").rglob("*-ds*.csv")) == [f"{'b' * 24}_3-ds1-1.csv", f"{'b' * 24}_5-ds1-2.csv"]
    assert rows(state.read(), "last_id") == [(NEVER_ID,)] * 3


def test_incremental_job(spark, rows, chosen, tmp_path):
    promote_datasets(spark, chosen, "2020-01-01 00:00:00")
    publish_datasets(spark, chosen, lambda name: str(tmp_path / name))
    state = state_table(spark, str(tmp_path / "state"))
    files = incremental_datasets(spark, chosen, lambda name: str(tmp_path / name), state, "f" * 24)
    assert sorted(f.rsplit("_", 1)[1] for f in files) == ["2-ds3-1.csv", "3-ds1-1.csv", "5-ds2-1.csv"]
    assert read_raw_csv(spark, str(tmp_path / "out" / "ds2"), ["num", "seen", "extra"]).count() == 5
    assert incremental_datasets(spark, chosen, lambda name: str(tmp_path / name), state, "f" * 24) == []


def test_forced_collection_and_dry_run(spark, rows, chosen, tmp_path):
    promote_datasets(spark, chosen, "2020-01-01 00:00:00")
    reports = publish_datasets(spark, chosen, lambda name: str(tmp_path / name), "nowrite", "other")
    assert len(reports) == 1 and rows(reports[0], "record_read", "record_write") == [(2, 0), (3, 0), (5, 0)]
    assert not (tmp_path / "other").exists()


def test_state_per_tenant(spark, rows, tmp_path):
    state = state_table(spark, str(tmp_path / "tenants"), TENANT_SCHEMA)
    state.write(merge_state(state.read(), spark.createDataFrame([("t1", "b" * 24)], TENANT_SCHEMA), TENANT_KEYS))
    wanted = spark.createDataFrame([("t1",), ("t2",)], "tenantcode string")
    assert rows(last_ids(wanted, state.read(), TENANT_KEYS)) == [("t1", "b" * 24), ("t2", "0" * 24)]
