import pytest
from pyspark.sql import functions as F

from tidemark.plans import marts, reports
from tidemark.plans.marts import Mart
from tidemark.sinks.csv_out import write_report


def listed(fail: bool = False, calls: list | None = None) -> list[Mart]:
    def a(f):
        (calls if calls is not None else []).append("a")
        return f("src").withColumn("n", F.col("n") * 10)

    def b(f):
        if fail:
            raise RuntimeError("broken off")
        return f("a").join(f("other"), "k", "left")

    return [Mart("a", a, keys=("k",), history=True, unique=True), Mart("other", lambda f: f("a").select("k", F.lit(1).alias("m")), ("a",), ("k",)), Mart("b", b, ("a", "other"))]


@pytest.fixture()
def sources(spark):
    return {"src": spark.createDataFrame([("x", 1), ("y", 2)], "k string, n int")}


@pytest.fixture()
def prefix(spark, tmp_path):
    begin = f"t{abs(hash(str(tmp_path)))}_"
    yield begin
    for found in spark.catalog.listTables():
        if found.name.startswith(begin):
            spark.sql(f"DROP {'VIEW' if found.tableType == 'VIEW' else 'TABLE'} IF EXISTS {found.name}")


def test_a_broken_load_goes_on_and_views_move_when_all_is_there(spark, rows, tmp_path, sources, prefix):
    root, calls = str(tmp_path), []

    def load(moment, **options):
        return marts.load_marts(spark, listed(**options), sources.__getitem__, root, moment, prefix, buckets=2)

    load("2024-01-01 00:00:00", calls=calls)
    sources["src"] = spark.createDataFrame([("z", 5)], "k string, n int")
    with pytest.raises(RuntimeError):
        load("2024-01-02 00:00:00", calls=calls, fail=True)
    assert rows(spark.table(f"{prefix}a")) == [("x", 10), ("y", 20)]  # readers still see the first load
    load("2024-01-02 00:00:00", calls=calls)
    assert len(calls) == 2  # the mart that was finished is not built again
    assert rows(spark.table(f"{prefix}b")) == [("z", 50, 1)]
    load("2024-01-02 00:00:00")
    kept = marts.history(spark, root, "a").select("k", "n", F.col("ts_inserimento").cast("string"))
    assert rows(kept) == [("x", 10, "2024-01-01 00:00:00"), ("y", 20, "2024-01-01 00:00:00"), ("z", 50, "2024-01-02 00:00:00")]
    load("2024-01-03 00:00:00")
    assert sorted(p.name for p in (tmp_path / "a").iterdir()) == ["20240102000000", "20240103000000"]


def test_a_lost_metastore_entry_is_made_again(spark, rows, tmp_path, sources, prefix):
    def load():
        return marts.load_marts(spark, listed(), sources.__getitem__, str(tmp_path), "2024-01-01", prefix, buckets=2)

    load()
    spark.sql(f"DROP TABLE {prefix}a__20240101")
    assert rows(load()("b")) == [("x", 10, 1), ("y", 20, 1)]


def test_repeated_keys_and_empty_marts(spark, tmp_path, sources, prefix):
    sources["src"] = sources["src"].limit(0)
    assert marts.load_marts(spark, listed(), sources.__getitem__, f"{tmp_path}/1", "2024", prefix)("b").count() == 0
    sources["src"] = spark.createDataFrame([("x", 1), ("x", 2)], "k string, n int")
    with pytest.raises(marts.RepeatedKeys):
        marts.load_marts(spark, listed(), sources.__getitem__, f"{tmp_path}/2", "2025", prefix)


def test_only_what_is_wanted_is_written(spark, tmp_path, sources, prefix):
    assert [m.name for m in marts.needed(listed(), ["other"])] == ["a", "other"]
    marts.load_marts(spark, listed(), sources.__getitem__, str(tmp_path), "2024", prefix, ["other"])
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "a_storico", "other"]


def test_marts_of_one_key_are_joined_without_a_shuffle(spark, tmp_path, sources, prefix):
    frames = marts.load_marts(spark, listed(), sources.__getitem__, str(tmp_path), "2024", prefix, buckets=2)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = frames("a").join(frames("other"), "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_report_lines_by_type(spark, tmp_path):
    df = spark.sql("""SELECT * FROM VALUES ('b "q"; c', 1, 1.5D, true, timestamp'2020-01-02 03:04:05', 2.50BD), (NULL, NULL, NULL, NULL, NULL, NULL),
      ('', -3, 1e10D, false, timestamp'2020-01-02 00:00:00', 0BD) AS t(`a"x`, i, d, f, t, c)""")
    ordered = df.repartition(3).orderBy(F.col("i").asc_nulls_last())
    write_report(ordered, str(tmp_path / "one"), single_file=True)
    part, = (tmp_path / "one").glob("part-*")
    lines = ['"a""x";"i";"d";"f";"t";"c"', '"";-3;1.0E10;"false";"2020-01-02T00:00:00.000Z";0.00', '"b ""q""; c";1;1.5;"true";"2020-01-02T03:04:05.000Z";2.50', ";;;;;"]
    assert part.read_text() == "\n".join(lines) + "\n"
    write_report(spark.range(0, 100, 1, 4).orderBy(F.desc("id")), str(tmp_path / "many"))
    texts = [p.read_text().splitlines() for p in sorted((tmp_path / "many").glob("part-*"))]
    assert all(t[0] == '"id"' for t in texts if t) and [int(x) for t in texts for x in t[1:]] == list(range(99, -1, -1))
    write_report(df.where("false"), str(tmp_path / "none"), single_file=True)
    assert [p.read_text() for p in (tmp_path / "none").glob("part-*") if p.stat().st_size] == [lines[0] + "\n"]


def test_dated_reports_in_order(spark, tmp_path):
    sizes = ["hive_dim_MB", "hdfs_csv_dim_MB", "bin_dim_MB", "solrtenantcollmb", "hdfs_stage_dim", "dimTotale"]
    card = spark.range(200).select(F.format_string("T%05d", 199 - F.col("id")).alias("tenantcode"), *[F.lit(1.5).alias(c) for c in sizes], *[F.lit(1).alias(c) for c in ("num_smartobjects", "num_streams", "tot_so_stream")])
    written = marts.export_reports({"info_tenant_completo": card}.__getitem__, str(tmp_path), "2024-03-04 05:06:07", ["dimensioni_tenant"])
    assert written == {"dimensioni_tenant": f"{tmp_path}/dimensioni_tenant_20240304_050607"}
    part, = (tmp_path / "dimensioni_tenant_20240304_050607").glob("part-*")
    lines = part.read_text().splitlines()
    assert len(lines) == 201 and lines[1] == '"T00000";"1,5";"1,5";"1,5";"1,5";"1,5";1;1;1;"1,5"' and lines[1:] == sorted(lines[1:])


def test_large_single_file_report_is_cut_into_ranges(spark, tmp_path):
    df = spark.range(0, 1000, 1, 3).select(F.concat(F.lit("x" * 50), F.col("id")).alias("t"), F.col("id").alias("n"))
    write_report(df.orderBy(F.desc("n")), str(tmp_path / "r"), single_file=True, bytes_per_file=10_000)
    texts = [p.read_text().splitlines() for p in sorted((tmp_path / "r").glob("part-*"))]
    assert len(texts) == 6
    assert all(t[0] == '"t";"n"' for t in texts)
    assert max(map(len, texts)) < 300
    assert [int(line.rsplit(";", 1)[1]) for t in texts for line in t[1:]] == list(range(999, -1, -1))


def test_report_of_equal_call_rates_has_an_order_to_cut(spark):
    calls = spark.range(0, 2000, 1, 4).selectExpr("concat('T', id) AS tenantcode", "2000L AS anno", "1L AS mese", "1L AS num_chiamate_mese", "1L AS fruitori_distinti",
                                                  "0.5D AS media_al_sec", "NULL AS ultima_chiamata", "1D AS media_chiamate_anno", "'' AS datadisattivazione")
    usage = spark.range(2000).selectExpr("concat('T', id) AS tenantcode", "'e' AS idecosystem", "concat('n', id) AS tenantname", "'yes' AS in_consuntivo", "'no' AS pagante")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = reports.report_calls(calls, usage).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 1500
