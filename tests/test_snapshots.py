"""Serving collections commit by commit: broken runs, two writers, pinned readers, retention and pruned id ranges."""

import pytest
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.plans.incremental import pending_in_snapshot
from tidemark.plans.publish import publish
from tidemark.sinks import serving as store
from tidemark.sources import snapshots
from tidemark.sources.serving import read_collection

DOC = "id string, iddataset_l bigint, datasetversion_l bigint, origin_s string, value_d double"


def docs(spark, *rows):
    return spark.createDataFrame([(f"{d}{i}", d, v, "datalake", float(x)) for d, v, i, x in rows], DOC)


@pytest.fixture
def collection(spark, tmp_path):
    path = str(tmp_path / "c")
    store.write_partitions(docs(spark, (1, 1, "a", 1), (1, 2, "b", 2), (2, 1, "c", 3), (3, 1, "d", 4)), path)
    return path


def values(spark, rows, path, number=None):
    return rows(read_collection(spark, path, number), "id", "iddataset_l", "datasetversion_l", "value_d")


@pytest.mark.parametrize("step", ["create_once", "data", "manifest"])
def test_broken_commit_leaves_readers_on_the_old_rows(spark, rows, collection, monkeypatch, step):
    before, writes = values(spark, rows, collection), []
    if step == "create_once":
        monkeypatch.setattr(Files, "create_once", lambda *_: (_ for _ in ()).throw(OSError("broken off")))
    else:
        real = type(spark.range(1).write).parquet

        def parquet(self, path, *args, **kwargs):
            real(self, path, *args, **kwargs)
            writes.append(path)
            if {"data": "/data/", "manifest": "/manifests/"}[step] in path:
                raise OSError("broken off")

        monkeypatch.setattr(type(spark.range(1).write), "parquet", parquet)
    with pytest.raises(OSError, match="broken off"):
        store.merge_documents(spark, collection, docs(spark, (1, 1, "a", 9), (2, 1, "z", 9)))
    monkeypatch.undo()
    assert values(spark, rows, collection) == before
    store.merge_documents(spark, collection, docs(spark, (1, 1, "a", 9), (2, 1, "z", 9)))
    assert values(spark, rows, collection) == [("1a", 1, 1, 9.0), ("1b", 1, 2, 2.0), ("2c", 2, 1, 3.0), ("2z", 2, 1, 9.0), ("3d", 3, 1, 4.0)]


def test_of_two_writers_the_second_begins_again(spark, rows, collection, monkeypatch):
    real, raced = store.commit, []

    def overtaken(spark_, base, *args, **kwargs):
        if not raced:
            raced.append(base.number)
            store.merge_documents(spark, collection, docs(spark, (1, 1, "y", 7)))
        return real(spark_, base, *args, **kwargs)

    monkeypatch.setattr(store, "commit", overtaken)
    store.merge_documents(spark, collection, docs(spark, (1, 1, "x", 8)))
    assert [v[0] for v in values(spark, rows, collection)] == ["1a", "1b", "1x", "1y", "2c", "3d"]
    with pytest.raises(snapshots.CommitConflict):
        snapshots.commit(spark, snapshots.snapshot(spark, collection, 1), docs(spark, (5, 1, "q", 1)))
    assert len(Files(spark).names(f"{collection}/data")) == len(Files(spark).names(f"{collection}/commits")) == 3


def test_readers_are_pinned_and_old_folders_go(spark, rows, collection):
    first = read_collection(spark, collection)
    for i in range(3):
        store.merge_documents(spark, collection, docs(spark, (1, 1, "a", 10 + i)))
    assert rows(first.where("id = '1a'"), "value_d") == [(1.0,)]
    assert [values(spark, rows, collection, n)[0][3] for n in (1, 2, 3, 4)] == [1.0, 10.0, 11.0, 12.0]
    store.delete_documents(spark, collection, 2)
    store.delete_documents(spark, collection, 2)  # nothing to delete makes no commit
    assert [v[0] for v in values(spark, rows, collection)] == ["1a", "1b", "3d"]
    (Files(spark)).make_folder(f"{collection}/data/{snapshots.COMMIT}=0000000002-left")
    assert snapshots.expire(spark, collection, 2) == [1, 2, 3]
    files = Files(spark)
    assert files.names(f"{collection}/commits") == ["0000000004", "0000000005"] == [n.split("-")[0] for n in files.names(f"{collection}/manifests")]
    # Of the first commit only the partitions in force are left, of the second and third nothing, nor of the broken run.
    kept = files.names(f"{collection}/data")
    assert [n.split("=")[1].split("-")[0] for n in kept] == ["0000000001", "0000000004", "0000000005"][: len(kept)]
    assert files.names(f"{collection}/data/{kept[0]}/iddataset_l=1") == ["datasetversion_l=2"]
    assert [v[0] for v in values(spark, rows, collection)] == ["1a", "1b", "3d"] and len(values(spark, rows, collection, 4)) == 4
    with pytest.raises(FileNotFoundError):
        read_collection(spark, collection, 1)


def test_an_emptied_collection(spark, rows, collection):
    for dataset in (1, 2, 3):
        store.delete_documents(spark, collection, dataset)
    assert values(spark, rows, collection) == [] and read_collection(spark, collection).columns == DOC.replace(" string", "").replace(" bigint", "").replace(" double", "").split(", ")
    report = publish(spark, collection, docs(spark, (1, 1, "a", 5)))
    assert rows(report, "record_before", "record_after") == [(0, 1)]
    assert rows(read_collection(spark, str(collection) + "-never")) == []


def test_each_datasets_own_range_decides_which_files_are_read(spark, rows, tmp_path):
    path = str(tmp_path / "wide")
    ids = F.format_string("%024x", F.col("id"))
    old = spark.range(0, 4000).select(ids.alias("id"), F.lit(1).cast("bigint").alias("iddataset_l"), F.lit(1).cast("bigint").alias("datasetversion_l"), F.lit("x").alias("origin_s"))
    new = old.where("id > '000000000000000000000f00'").withColumn("iddataset_l", F.lit(2).cast("bigint")).withColumn("id", F.regexp_replace("id", "^0", "1"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several small files stand for large ones
    store.write_partitions(old.unionByName(new), path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    of = snapshots.snapshot(spark, path)
    sizes = rows(of.manifest(spark), "iddataset_l", "documents")
    assert len(sizes) > 3 and sum(n for _, n in sizes) == 4000 + new.count()
    datasets = spark.createDataFrame([(1, 1), (2, 1)], "iddataset bigint, datasetversion bigint")
    last = f"{3990:024x}"
    state = spark.createDataFrame([(1, 1, last)], "iddataset bigint, datasetversion bigint, last_id string")
    found = pending_in_snapshot(spark, of, datasets, state, "f" * 24)
    assert found.groupBy("iddataset_l").count().orderBy("iddataset_l").collect() == [(1, 9), (2, new.count())]
    # The new dataset is read whole, of the old one only the file with its last ids.
    assert sum("iddataset_l=1" in f for f in found.inputFiles()) == 1
    assert not pending_in_snapshot(spark, of, datasets.where("iddataset = 1"), state, last).count()
