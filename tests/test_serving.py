from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.plans.publish import PublishMismatch, publish, row_blocks
from tidemark.sinks.serving import check_mode, delete_documents, merge_documents, to_documents, write_partitions
from tidemark.sources.serving import count_and_max, in_partitions, read_collection, serving_count, serving_scan

DOC = "id string, iddataset_l bigint, datasetversion_l bigint, origin_s string, value_d double"


@pytest.fixture
def collection(spark, tmp_path):
    path = str(tmp_path / "collection")
    write_partitions(
        spark.createDataFrame(
            [("a1", 1, 1, "datalake", 1.0), ("a2", 1, 1, "speed", 2.0), ("a3", 1, 2, None, 3.0), ("b1", 2, 1, "datalake", 4.0)], DOC
        ),
        path,
    )
    return path


def docs(spark, rows, path):
    return rows(read_collection(spark, path), "id", "iddataset_l", "datasetversion_l", "value_d")


def test_upsert_replaces_by_id_across_datasets(spark, rows, collection):
    new = spark.createDataFrame([("a1", 2, 1, "datalake", 9.0), ("c1", 3, 1, "speed", 5.0), ("c1", 3, 1, "speed", 6.0)], DOC)
    for _ in range(2):  # the second run changes nothing
        merge_documents(spark, collection, new, newest_first=[F.desc("value_d")])
        assert docs(spark, rows, collection) == [
            ("a1", 2, 1, 9.0), ("a2", 1, 1, 2.0), ("a3", 1, 2, 3.0), ("b1", 2, 1, 4.0), ("c1", 3, 1, 6.0)
        ]


def test_upsert_removes_an_emptied_partition(spark, rows, collection):
    merge_documents(spark, collection, spark.createDataFrame([("a3", 1, 1, "speed", 7.0)], DOC))
    assert docs(spark, rows, collection) == [("a1", 1, 1, 1.0), ("a2", 1, 1, 2.0), ("a3", 1, 1, 7.0), ("b1", 2, 1, 4.0)]
    assert not Files(spark).exists(f"{collection}/iddataset_l=1/datasetversion_l=2")


def test_datasets_with_different_columns_share_a_collection(spark, rows, collection):
    other = spark.createDataFrame([("z1", 9, 1, "datalake", "x")], "id string, iddataset_l int, datasetversion_l int, origin_s string, name_s string")
    merge_documents(spark, collection, other)
    merge_documents(spark, collection, spark.createDataFrame([("z2", 9, 1, "datalake", 5.0)], DOC))
    stored = read_collection(spark, collection)
    assert rows(stored.where("iddataset_l = 9"), "id", "name_s", "value_d") == [("z1", "x", None), ("z2", None, 5.0)]
    assert dict(stored.dtypes)["iddataset_l"] == "bigint" and stored.count() == 6
    Files(spark).delete(f"{collection}/_schema.json")
    assert set(read_collection(spark, collection).columns) == set(stored.columns)


def test_documents_need_a_dataset(spark, collection):
    with pytest.raises(ValueError, match="without a dataset"):
        merge_documents(spark, collection, spark.createDataFrame([("z1", None, 1, "datalake", 1.0)], DOC))


def test_upsert_leaves_other_partitions_alone(spark, collection):
    files = Files(spark)
    before = files.names(f"{collection}/iddataset_l=2/datasetversion_l=1")
    merge_documents(spark, collection, spark.createDataFrame([("n1", 1, 1, "speed", 7.0)], DOC))
    assert files.names(f"{collection}/iddataset_l=2/datasetversion_l=1") == before


def test_delete_ignores_version_unless_asked_and_keeps_unknown_origin(spark, rows, collection):
    delete_documents(spark, collection, 1, version=2)
    assert len(docs(spark, rows, collection)) == 4
    delete_documents(spark, collection, 1)
    assert [d[0] for d in docs(spark, rows, collection)] == ["a2", "a3", "b1"]
    delete_documents(spark, collection, 2)
    assert [d[0] for d in docs(spark, rows, collection)] == ["a2", "a3"]


def test_documents_convert_decimals_and_make_ids(spark):
    df = spark.createDataFrame([(Decimal("1.50"), 1)], "price decimal(5,2), _version int")
    doc = to_documents(df).first()
    assert doc["price"] == 1.5 and len(doc["id"]) == 36 and "_version" not in doc


def test_counts_and_scan_prune(spark, rows, collection):
    stored = read_collection(spark, collection)
    assert serving_count(stored, 1) == 3 == serving_count(stored, 1, -1) and serving_count(stored, 1, 2) == 1
    assert serving_count(stored, 1, None, "a1", "a3") == 2
    assert rows(count_and_max(stored)) == [(1, 1, 2, "a2"), (1, 2, 1, "a3"), (2, 1, 1, "b1")]
    plan = serving_scan(spark, collection, 1, 1, ["id"]).where("value_d > 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(iddataset_l" in plan and "PushedFilters: [IsNotNull(value_d), GreaterThan(value_d" in plan
    assert "ReadSchema: struct<id:string,value_d:double>" in plan


def test_publish_modes(spark, rows, collection):
    new = spark.createDataFrame([("p1", 1, 1, "datalake", 8.0), ("p2", 1, 1, "datalake", 9.0)], DOC)
    dry = publish(spark, collection, new, "nowrite")
    assert rows(dry, "record_read", "record_before", "record_after", "record_write") == [(2, 2, 2, 0)]
    for _ in range(2):
        done = publish(spark, collection, new, "Overwrite")
        assert rows(done, "record_read", "record_after", "record_write") == [(2, 3, 2)]
    assert [d[0] for d in docs(spark, rows, collection)] == ["a2", "a3", "b1", "p1", "p2"]
    done = publish(spark, collection, new.withColumn("id", F.concat("id", F.lit("x"))), "append")
    assert rows(done, "record_before", "record_after", "record_write") == [(3, 5, 2)]
    with pytest.raises(ValueError, match="nowrite, append, overwrite"):
        check_mode("truncate")


def test_publish_into_a_new_collection_and_mismatch(spark, rows, tmp_path):
    path = str(tmp_path / "new")
    new = spark.createDataFrame([("p1", 1, 1, "datalake", 8.0), ("p1", 1, 1, "datalake", 9.0)], DOC)
    with pytest.raises(PublishMismatch):
        publish(spark, path, new)
    assert rows(publish(spark, path, new.limit(1)), "record_before", "record_write") == [(1, 1)]


def test_row_blocks_are_half_open(spark, rows):
    df = spark.range(1, 251).withColumnRenamed("id", "sparkuniqueid")
    assert rows(row_blocks(df, 100)) == [(0, 99), (1, 100), (2, 51)]
    assert rows(row_blocks(df, 100, start=1)) == [(0, 100), (1, 100), (2, 50)]


def test_only_the_partitions_concerned_are_read(spark, rows, tmp_path):
    path = str(tmp_path / "pruned")
    docs = spark.createDataFrame([(f"{d}{v}", d, v, "datalake", d * 10 + v) for d in range(6) for v in (1, 2)], "id string, iddataset_l bigint, datasetversion_l bigint, origin_s string, x_i int")
    write_partitions(docs, path)
    stored = read_collection(spark, path)
    found = in_partitions(stored, docs.where("x_i IN (11, 42)"))
    assert rows(found, "x_i") == [(11,), (42,)]
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [", 1)[1].split("PushedFilters", 1)[0]
    assert "iddataset_l" in filters and " IN (" in filters
    assert in_partitions(stored, docs.limit(0)).count() == 0 and in_partitions(stored, docs.where("x_i = 11").select("iddataset_l")).count() == 2
