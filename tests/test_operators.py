import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import join_ignoring_case, join_on_code_suffix, left_join_many
from tidemark.operators.latest import latest_versions, newest_per_key
from tidemark.operators.lists import comma_list, pivot_params
from tidemark.operators.merge import delete_where, replace_by_key, upsert
from tidemark.operators.rowid import with_dense_row_id
from tidemark.operators.sampling import sample_keys, sample_rows
from tidemark.plans.promote import promoted_rows


def test_left_join_many_equals_left_join(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), (None, 4), (None, 5), ("a", 6)], "k string, x int")
    hot = [("a", i) for i in range(50)] + [("b", 1), ("z", 2), (None, 3)]
    right = spark.createDataFrame(hot, "k string, y int")
    assert rows(left_join_many(left, right, ["k"])) == rows(left.join(right, "k", "left").select("k", "x", "y"))


def test_left_join_many_on_two_keys(spark, rows):
    left = spark.createDataFrame([(1, 1), (1, None), (2, 2)], "a int, b int")
    right = spark.createDataFrame([(1, 1, "x"), (1, None, "y")], "a int, b int, v string")
    assert rows(left_join_many(left, right, ["a", "b"])) == rows(left.join(right, ["a", "b"], "left"))


def test_join_ignoring_case(spark, rows):
    a = spark.createDataFrame([("Tb", "DB"), ("x", "DB")], "t string, d string")
    b = spark.createDataFrame([("TB", "db", 1)], "t2 string, d2 string, v int")
    assert rows(join_ignoring_case(a, b, [("t", "t2"), ("d", "d2")], "left"), "t", "v") == [("Tb", 1), ("x", None)]


def test_suffix_join_tells_12_from_112(spark, rows):
    ids = spark.createDataFrame([(12, 1)], "id int, v int")
    coded = spark.createDataFrame([("ds_12", 1), ("ds_112", 1), ("ds_12", 2), ("other_a_12", 1), ("ds12", 1)], "code string, cv int")
    assert rows(join_on_code_suffix(ids, "id", "v", coded, "code", "cv"), "code") == [("ds_12",), ("other_a_12",)]


def test_latest_versions_are_numeric_and_keep_ties(spark, rows):
    df = spark.createDataFrame([("d", 9, "a"), ("d", 10, "b"), ("d", 10, "c"), ("e", None, "d"), (None, 1, "x")], "id string, v int, x string")
    assert rows(latest_versions(df, "id", "v"), "x") == [("b",), ("c",)]


def test_latest_versions_keep_the_null_key_out(spark, rows):
    df = spark.createDataFrame([(None, 1), (1, 2)], "id int, v int")
    assert rows(latest_versions(df, "id", "v")) == [(1, 2)]


def test_newest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, t int, x string")
    assert rows(newest_per_key(df, ["k"], [F.desc("t")])) == [(1, 2, "b"), (2, 1, "c")]


@pytest.mark.parametrize("order_by", [None, ["k", "id"]])
def test_dense_row_ids_are_1_to_n(spark, order_by):
    df = spark.range(0, 1000, 1, 7).select("id", (F.col("id") % 3 == 0).cast("int").alias("k"))
    numbered = with_dense_row_id(df, "n", order_by).orderBy("n").collect()
    assert [r["n"] for r in numbered] == list(range(1, 1001))
    if order_by:
        assert [(r["k"], r["id"]) for r in numbered] == sorted((r["k"], r["id"]) for r in numbered)
    assert sorted(r["id"] for r in numbered) == list(range(1000))


def test_dense_row_ids_with_one_hot_value_and_empty_parts(spark):
    df = spark.range(0, 300, 1, 5).select(F.lit(1).alias("k"))
    assert [r["n"] for r in with_dense_row_id(df, "n", ["k"]).orderBy("n").collect()] == list(range(1, 301))
    assert with_dense_row_id(df.where("k = 2"), "n").count() == 0


@pytest.mark.parametrize("ranges, few_files", [(1, 0), (1, 1000), (200, 0), (200, 1000)])
def test_dense_row_ids_over_ranges(spark, ranges, few_files):
    df = spark.range(0, 2000, 1, 9).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("_metadata"), F.lit("x").alias("a.b"))
    found = with_dense_row_id(df, "n", ["k"], ranges, few_files=few_files)
    assert found.columns == ["k", "_metadata", "a.b", "n"]
    got = [(r["k"], r["_metadata"]) for r in found.orderBy("n").collect()]
    assert [r["n"] for r in found.orderBy("n").collect()] == list(range(1, 2001))
    assert got == sorted((7 if i % 3 == 0 else i % 50, i) for i in range(2000))  # equal rows in the order of arrival


def test_dense_row_ids_spread_one_hot_value(spark):
    df = spark.range(0, 3000, 1, 6).select(F.lit(1).alias("k"), "id")
    found = with_dense_row_id(df, "n", ["k"], rows_per_range=300)
    per_file = [spark.read.parquet(f).count() for f in found.inputFiles() if "rowid-offsets" not in f]
    assert len(per_file) >= 8 and max(per_file) < 1000
    assert [r["id"] for r in found.orderBy("n").collect()] == list(range(3000))


def test_dense_row_ids_over_several_files_of_a_task(spark):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        found = with_dense_row_id(spark.range(0, 2500, 1, 2), "n", ["id"], 2)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert len(found.inputFiles()) >= 250
    assert [(r["id"], r["n"]) for r in found.orderBy("n").collect()] == [(i, i + 1) for i in range(2500)]


def test_merges(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert rows(replace_by_key(old, new, ["k"])) == [(1, "a"), (2, "c"), (3, "d")]
    twice = spark.createDataFrame([(2, "c"), (2, "z")], "k int, v string")
    once = upsert(old, twice, ["k"], [F.desc("v")])
    assert rows(once) == [(1, "a"), (2, "z")] == rows(upsert(once, twice, ["k"], [F.desc("v")]))


def test_delete_keeps_unknown(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, o string")
    assert rows(delete_where(df, F.col("o") == "x"), "k") == [(2,), (3,)]


def test_lists_and_pivot(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(comma_list(df, ["k"], "v", "l")) == [(1, "a,b"), (2, "")]
    params = spark.createDataFrame([(1, "numRows", "5"), (1, "other", "x"), (2, "totalSize", "7")], "id int, p string, v string")
    assert rows(pivot_params(params, "id", "p", "v", ["numRows", "totalSize"])) == [(1, "5", None), (2, None, "7")]


def test_samples(spark):
    df = spark.range(5000)
    assert 0 < sample_rows(df, 0.1, 3).count() < 1500
    one = {r[0] for r in sample_keys(df, "id", 0.1, 3).collect()}
    assert one == {r[0] for r in sample_keys(df.repartition(13), "id", 0.1, 3).collect()} and 300 < len(one) < 700
    assert sample_keys(df, "id", 1.0).count() == 5000 and sample_keys(df, "id", 0.0).count() == 0


def test_ids_of_large_dataset_numbers(spark):
    source = spark.range(3).withColumnRenamed("id", "num")
    found = {space: sorted(r["bda_id"] for r in promoted_rows(source, ["num"], "2018-10-01 00:00:00", id_space=space).collect()) for space in (42, 1 << 23, (1 << 24) - 1)}
    assert found[1 << 23][0][8:] == f"{(1 << 63) + 1:016x}" and found[(1 << 24) - 1][2][8:] == f"{((1 << 24) - 1 << 40) + 3:016x}"
    assert len({i for ids in found.values() for i in ids}) == 9
    with pytest.raises(ValueError):
        promoted_rows(source, ["num"], "2018-10-01 00:00:00", id_space=1 << 24)
