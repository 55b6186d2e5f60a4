import pytest
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.functions.objectid import NEVER_ID
from tidemark.plans import compaction
from tidemark.plans.export import full_export
from tidemark.plans.incremental import layouts, pending_documents, run_incremental_export
from tidemark.plans.state import last_ids, state_table
from tidemark.sinks.csv_out import write_report, write_tasks
from tidemark.sources.csv_files import read_raw_csv
from tidemark.sources.listing import folder_sizes, file_sizes, raw_csv_files

COLUMNS = ["type", "note", "size"]


def oid(second: int, low: int = 0) -> str:
    return f"{second:08x}{low:016x}"


@pytest.fixture
def docs(spark):
    notes = ["plain", "", None, 'say "x"; a,b', "two\nlines", "  padded  "]
    data = [(oid(1_700_000_000 + i, i), i % 3, 1, "datalake", f"k{i % 2}", notes[i % 6], None if i % 5 == 0 else i) for i in range(60)]
    return spark.createDataFrame(
        data, "id string, iddataset_l bigint, datasetversion_l bigint, origin_s string, type_s string, note_s string, size_l bigint"
    )


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    described = spark.createDataFrame([(d, 1, f"ds{d}", f"{root}/ds{d}") for d in range(3)], "iddataset bigint, datasetversion bigint, datasetcode string, folder string")
    return root, described, state_table(spark, str(tmp_path / "state"))


def stored(spark, rows, root):
    return rows(read_raw_csv(spark, root, COLUMNS, multi_line=True, recursive=True))


def expected(docs, rows):
    return rows(docs.select("type_s", F.coalesce("note_s", F.lit("")), F.col("size_l").cast("string")))


def test_full_export_round_trip_and_replacement(spark, rows, docs, lake):
    root, described, state = lake
    full_export(spark, docs, described, state, "overwrite", oid(1))
    full_export(spark, docs, described, state, "overwrite", oid(2))
    assert stored(spark, rows, root) == expected(docs, rows)
    assert Files(spark).names(f"{root}/ds0") == [f"{oid(2)}_20-ds0-1.csv"]
    assert rows(state.read(), "last_id") == [(NEVER_ID,)] * 3
    full_export(spark, docs, described, state, "append", oid(3))
    assert len(Files(spark).names(f"{root}/ds0")) == 2
    assert full_export(spark, docs, described, state, "nowrite", oid(4)) == []
    assert len(Files(spark).names(f"{root}/ds0")) == 2


def test_hot_dataset_is_split_into_files(spark, rows, docs, lake):
    root, described, state = lake
    skewed = docs.withColumn("iddataset_l", F.when(F.col("size_l") < 10, 1).otherwise(0).cast("bigint"))
    full_export(spark, skewed, described, state, "overwrite", oid(5), rows_per_file=10)
    found = rows(raw_csv_files(spark, root), "datasetcode", "file_rows", "oid")
    assert sum(r[1] for r in found) == 60 and len([r for r in found if r[0] == "ds0"]) > 3
    assert len({r[2] for r in found if r[0] == "ds0"}) == len([r for r in found if r[0] == "ds0"])
    assert stored(spark, rows, root) == expected(skewed, rows)


def test_incremental_runs_partition_the_documents(spark, rows, docs, lake):
    root, described, state = lake
    bounds = [oid(1_700_000_019, 19), oid(1_700_000_019, 19), oid(1_700_000_040), oid(1_800_000_000)]
    counts = [len(run_incremental_export(spark, docs, described, state, upper)) for upper in bounds]
    assert counts == [3, 0, 3, 3]
    assert stored(spark, rows, root) == expected(docs, rows)
    assert rows(state.read(), "last_id") == [(oid(1_700_000_000 + i, i),) for i in (57, 58, 59)]


def test_incremental_rerun_overwrites_the_same_file(spark, rows, docs, lake):
    root, described, state = lake
    before = state.read()
    run_incremental_export(spark, docs, described, state, oid(1_800_000_000))
    state.write(spark.createDataFrame([], before.schema))  # as if the state had been lost after the files
    run_incremental_export(spark, docs, described, state, oid(1_800_000_000))
    assert stored(spark, rows, root) == expected(docs, rows)


def test_switched_off_and_unknown_datasets_are_not_exported(spark, rows, docs, lake):
    root, described, state = lake
    state.write(spark.createDataFrame([(0, 1, NEVER_ID)], state.schema))
    run_incremental_export(spark, docs, described.where("iddataset < 2"), state, oid(1_800_000_000))
    assert Files(spark).names(root) == ["ds1"]
    wanted = spark.createDataFrame([(0, 1), (9, 1)], "iddataset bigint, datasetversion bigint")
    assert rows(last_ids(wanted, state.read())) == [(0, 1, NEVER_ID), (9, 1, "0" * 24)]


def test_layouts(spark):
    df = spark.sql("SELECT array(named_struct('fieldName','a','dataType','int')) AS campi, 'data' AS family, id FROM range(3)")
    (fields, family, group), = layouts(df)
    assert fields == [("a", "int")] and family == "data" and group.columns == df.columns and group.count() == 3
    assert [x[0] for x in layouts(df.drop("campi"))] == [None]


def test_each_dataset_has_its_own_fields(spark, rows, lake):
    """One collection, two field lists, names that the toolkit also uses, and one name with two types."""
    root, described, state = lake
    docs = spark.createDataFrame(
        [(oid(5, 1), 0, 1, "a", None, 1, None, 7), (oid(5, 2), 1, 1, None, 2.5, None, "p", None), (oid(5, 3), 2, 1, None, 3.5, None, "q", None)],
        "id string, iddataset_l bigint, datasetversion_l bigint, temp_s string, temp_d double, year_i int, part_s string, iddataset_i int",
    )
    first, second = [("Temp", "string"), ("year", "int"), ("iddataset", "int")], [("temp", "double"), ("part", "string"), ("path", "string")]
    fields = spark.createDataFrame(
        [(0, first, "data"), (1, second, "data"), (2, second, "data")],
        "iddataset bigint, campi array<struct<fieldName:string,dataType:string>>, family string",
    )
    run_incremental_export(spark, docs, described.join(fields, "iddataset"), state, oid(9))
    files = {name: Files(spark).names(f"{root}/{name}") for name in ("ds0", "ds1", "ds2")}
    text = {name: (spark.read.text(f"{root}/{name}/{files[name][0]}").collect()) for name in files}
    assert [r[0] for r in text["ds0"]] == ["temp,year,iddataset", "a,1,7"]
    assert [r[0] for r in text["ds1"]] == ["temp,part,path", '2.5,p,""']
    assert [r[0] for r in text["ds2"]] == ["temp,part,path", '3.5,q,""']
    assert rows(state.read(), "last_id") == [(oid(5, i),) for i in (1, 2, 3)]


def test_pending_scan_is_pruned(spark, docs, lake, tmp_path):
    _, described, state = lake
    docs.write.partitionBy("iddataset_l", "datasetversion_l").parquet(str(tmp_path / "coll"))
    state.write(spark.createDataFrame([(0, 1, NEVER_ID), (1, 1, oid(1_700_000_030)), (2, 1, oid(1_700_000_010))], state.schema))
    found = pending_documents(spark.read.schema(docs.schema).parquet(str(tmp_path / "coll")), described, state.read(), oid(1_800_000_000))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert f"GreaterThan(id,{oid(1_700_000_010)})" in plan and "iddataset_l#" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert {r["iddataset_l"] for r in found.collect()} == {1, 2} and found.count() == 10 + 17


def test_reserved_names_are_refused(spark, lake):
    root, described, state = lake
    docs = spark.createDataFrame([(oid(5), 0, 1, "x")], "id string, iddataset_l bigint, datasetversion_l bigint, __tm_part_s string")
    with pytest.raises(ValueError, match="__tm_"):
        run_incremental_export(spark, docs, described, state, oid(9))


RAW = ["time", "sensor", "v"]


def raw_file(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(["time,sensor,v", *lines]) + "\n")


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw" / "so_x" / "st"
    march, april = 1_520_000_000, 1_523_000_000
    raw_file(root, f"{oid(march)}_2-ds-1.csv", ["t1,a,1", "time,sensor,v", "t2,b,2"])
    raw_file(root, f"{oid(march + 9)}_2-ds-1.csv", [",c,3", 't3,"x\ny",""'])
    raw_file(root, f"{oid(april)}_1-ds-1.csv", ["t4,d,4"])
    raw_file(root, f"{oid(march)}_1-ds-2.csv", ["t5,e,5"])
    raw_file(root, "notes-ds-1.csv", ["ignored,x,y"])
    return tmp_path, root, oid(march + 9)


def test_compaction_keeps_the_rows_and_archives_the_sources(spark, rows, raw):
    base, root, newest = raw
    done = compaction.compact(spark, str(base / "raw"), str(base / "archive"), RAW)
    assert [p.rsplit("/", 1)[1] for p in done] == [f"{newest}_4-ds-1.csv"]
    found = rows(read_raw_csv(spark, done, RAW, multi_line=True))
    assert found == sorted([("t1", "a", "1"), ("t2", "b", "2"), ("t3", "x\ny", ""), (None, "c", "3")], key=lambda r: [(v is None, str(v)) for v in r])
    assert len(list(root.glob("*.csv"))) == 4  # compacted month, two single-file months, the odd name
    assert len(list((base / "archive").rglob("*.csv"))) == 2
    assert compaction.compact(spark, str(base / "raw"), str(base / "archive"), RAW) == []


def test_compaction_leaves_the_files_columns_alone(spark, rows, tmp_path):
    names = ["time", "year", "path", "part", "group_id", "oid"]
    folder = tmp_path / "raw" / "d"
    folder.mkdir(parents=True)
    for i in range(2):
        (folder / f"{oid(1_520_000_000 + i)}_1-ds-1.csv").write_text(f"{','.join(names)}\nt{i},198{i},p{i},a,b,c\n")
    done = compaction.compact(spark, str(tmp_path / "raw"), str(tmp_path / "archive"), names)
    assert rows(read_raw_csv(spark, done, names)) == [(f"t{i}", f"198{i}", f"p{i}", "a", "b", "c") for i in range(2)]


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_broken_compaction_is_finished_by_the_next_run(spark, rows, raw, monkeypatch, moved):
    base, root, newest = raw
    real, count = Files.rename, []

    def break_off(self, source, target):
        if len(count) == moved:
            raise OSError("broken off")
        count.append(target)
        real(self, source, target)

    monkeypatch.setattr("tidemark.files.RENAMES_AT_ONCE", 1)
    monkeypatch.setattr(Files, "rename", break_off)
    with pytest.raises(OSError):
        compaction.compact(spark, str(base / "raw"), str(base / "archive"), RAW)
    monkeypatch.setattr(Files, "rename", real)
    compaction.compact(spark, str(base / "raw"), str(base / "archive"), RAW)
    assert sorted(p.name for p in root.glob(f"{oid(1_520_000_000)[:6]}*-ds-1.csv")) == [f"{newest}_4-ds-1.csv"]
    assert read_raw_csv(spark, str(root), RAW, multi_line=True).count() == 7


@pytest.mark.parametrize("moved", [None, 0, 1, 2, 3])
def test_a_late_file_meets_a_compacted_month(spark, raw, monkeypatch, moved):
    """A month with an empty file: the compacted file has the name of one of its own sources."""
    base, root, _ = raw
    august = 1_533_500_000
    raw_file(root, f"{oid(august)}_0-ds-1.csv", [])
    raw_file(root, f"{oid(august + 5)}_2-ds-1.csv", ["a1,x,1", "a2,x,2"])
    month = lambda: sorted(p.name for p in root.glob(f"{oid(august)[:5]}*-ds-1.csv"))

    def run():
        return compaction.compact(spark, str(base / "raw"), str(base / "archive"), RAW)

    def rows_of_month():
        return sorted(r[0] for r in read_raw_csv(spark, [str(root / n) for n in month()], RAW, multi_line=True).select("time").collect())

    run()
    assert month() == [f"{oid(august + 5)}_2-ds-1.csv"] and rows_of_month() == ["a1", "a2"]
    raw_file(root, f"{oid(august + 1)}_1-ds-1.csv", ["late,x,3"])
    if moved is not None:
        real, count = Files.rename, []

        def break_off(self, source, target):
            if len(count) == moved:
                raise OSError("broken off")
            count.append(target)
            real(self, source, target)

        monkeypatch.setattr("tidemark.files.RENAMES_AT_ONCE", 1)
        monkeypatch.setattr(Files, "rename", break_off)
        if moved < 3:
            with pytest.raises(OSError):
                run()
        else:
            run()
        monkeypatch.setattr(Files, "rename", real)
    for _ in range(2):
        run()
        assert month() == [f"{oid(august + 5)}_3-ds-1.csv"] and rows_of_month() == ["a1", "a2", "late"]


def test_compaction_of_a_large_month_makes_several_files(spark, rows, tmp_path):
    root = tmp_path / "raw" / "d"
    for i in range(8):
        raw_file(root, f"{oid(1_520_000_000 + i)}_20-ds-1.csv", ["t,a,b"] * 20)  # copies of one row
    size = sum(p.stat().st_size for p in root.iterdir())
    done = compaction.compact(spark, str(tmp_path / "raw"), str(tmp_path / "archive"), RAW, bytes_per_file=size // 3 + 1)
    assert len(done) == 3 and read_raw_csv(spark, done, RAW).count() == 160
    assert max(int(p.rsplit("/", 1)[1].split("_")[1].split("-")[0]) for p in done) < 100
    assert compaction.compact(spark, str(tmp_path / "raw"), str(tmp_path / "archive"), RAW, bytes_per_file=size // 3 + 1) == []


def test_listing(spark, rows, raw):
    base, *_ = raw
    assert rows(folder_sizes(file_sizes(spark, str(base / "raw")), str(base / "raw")), "folder", "files") == [("so_x", 5)]
    assert raw_csv_files(spark, str(base / "raw")).count() == 4


def test_report_text(spark, tmp_path):
    df = spark.createDataFrame([("a;b", None, 1)], "x string, y string, n int")
    write_report(df, str(tmp_path / "r"), single_file=True)
    part, = (tmp_path / "r").glob("part-*.txt")
    assert part.read_text() == '"x";"y";"n"\n"a;b";;1\n'


def test_write_tasks(spark):
    assert (write_tasks(spark, 0, 0), write_tasks(spark, 2, 0.1), write_tasks(spark, 100, 2.5), write_tasks(spark, 100, 60.2)) == (1, 2, 4, 61)
