import pytest
from pyspark.sql import functions as F

from tidemark.files import Files
from tidemark.functions.objectid import NEVER_ID
from tidemark.plans import logs
from tidemark.plans.promote import promote, promoted_rows
from tidemark.plans.state import advance_state, merge_state, state_table, stop_incremental
from tidemark.session import scratch_root
from tidemark.sinks.stats import append_stats, stats_rows
from tidemark.sinks.tables import StateConflict, append_by_day, replace_table, save_table, snapshot
from tidemark.sources.csv_files import read_raw_csv
from tidemark.sources.jdbc import jdbc_options
from tidemark.streaming.incremental import start_incremental_export
from tidemark.streaming.logs import log_stream, start_log_ingest


def test_scratch_folder_is_the_session_setting(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_root(spark) == configured.rstrip("/") if configured else scratch_root(spark)


def test_save_and_replace_table(spark, rows, tmp_path):
    assert save_table(spark.range(3), "t_saved", str(tmp_path / "t")).count() == 3
    for size in (2, 5):
        assert replace_table(spark.range(size), "t_replaced").count() == size
    assert {t.name for t in spark.catalog.listTables()} >= {"t_saved", "t_replaced"}
    assert not any("__" in t.name for t in spark.catalog.listTables())
    replace_table(spark.table("t_replaced").where("id > 1"), "t_replaced")  # may read what it replaces
    assert rows(spark.table("t_replaced")) == [(2,), (3,), (4,)]


def test_snapshot_overwrites_and_history_grows(spark, tmp_path):
    path = str(tmp_path / "s")
    snapshot(spark.range(2), path, "2024-01-01 00:00:00")
    snapshot(spark.range(3), path, "2024-01-02 00:00:00")
    assert spark.read.orc(f"{path}/current").count() == 3
    assert [r[:] for r in spark.read.orc(f"{path}/history").groupBy("ts_inserimento").count().orderBy("count").select("count").collect()] == [(2,), (3,)]


def test_state_table_versions(spark, rows, tmp_path):
    state = state_table(spark, str(tmp_path / "state"))
    assert state.read().count() == 0
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], state.schema)
    state.write(first)
    state.write(merge_state(state.read(), stop_incremental(first.where("iddataset = 2"))))
    state.write(merge_state(state.read(), spark.createDataFrame([(3, 1, "c")], state.schema)))
    assert rows(state.read()) == [(1, 1, "a"), (2, 1, NEVER_ID), (3, 1, "c")]
    (tmp_path / "state" / "copy=9-left").mkdir()  # a copy that was never committed
    (tmp_path / "state" / "n=9.left").write_text("copy=9-left")
    assert state.read().count() == 3


def test_two_writers_of_a_state(spark, rows, tmp_path):
    state, other = (state_table(spark, str(tmp_path / "state")) for _ in range(2))
    state.write(spark.createDataFrame([(1, 1, "a")], state.schema))
    add = lambda n: lambda now: merge_state(now, spark.createDataFrame([(n, 1, "x")], state.schema))
    with pytest.raises(StateConflict):
        stale = state.read()
        other.update(add(2))
        state.write(add(3)(stale), after=1)
    turns = []

    def overtaken(now):
        turns.append(now.count())
        if len(turns) == 1:
            other.update(add(4))
        return add(3)(now)

    state.update(overtaken)
    assert turns == [2, 3] and rows(state.read()) == [(1, 1, "a"), (2, 1, "x"), (3, 1, "x"), (4, 1, "x")]
    held = state_table(spark, str(tmp_path / "state2"))
    held.write(spark.createDataFrame([(1, 1, NEVER_ID), (2, 1, "1" * 24)], state.schema))
    held.update(lambda now: advance_state(now, spark.createDataFrame([(1, 1, "5" * 24), (2, 1, "2" * 24), (3, 1, "3" * 24)], state.schema)))
    assert rows(held.read()) == [(1, 1, NEVER_ID), (2, 1, "2" * 24), (3, 1, "3" * 24)]


def test_a_table_is_never_missing(spark, rows, tmp_path, monkeypatch):
    root = str(tmp_path / "tables")
    two = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    assert replace_table(two, "t_moved", root).count() == 2
    first = spark.table("t_moved")

    failing = two.withColumn("y", F.raise_error(F.lit("source fails")).cast("string"))
    for broken in range(2):
        with pytest.raises(Exception, match="source fails"):
            replace_table(failing, "t_moved", root)
        assert rows(spark.table("t_moved")) == [(1, "a"), (2, "b")]
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (_ for _ in ()).throw(OSError("broken off")) if text.startswith("ALTER") else sql(self, text, *a, **k))
    with pytest.raises(OSError):
        replace_table(two.where("x > 1"), "t_moved", root)
    monkeypatch.undo()
    assert rows(spark.table("t_moved")) == [(1, "a"), (2, "b")]
    replace_table(two.where("x = 1").withColumn("z", F.lit(5)), "t_moved", root)
    assert rows(spark.table("t_moved")) == [(1, "a", 5)] and rows(first) == [(1, "a"), (2, "b")]
    assert len(list((tmp_path / "tables" / "t_moved").glob("v=*"))) == 2  # the one in force and the one before it
    replace_table(spark.table("t_moved").select("z"), "t_moved", root)  # fewer columns: made anew
    assert rows(spark.table("t_moved")) == [(5,)]
    save_table(spark.range(4), "t_managed")
    assert replace_table(spark.range(6), "t_managed", root).count() == 6


def test_promotion(spark, rows):
    source = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    plain = promoted_rows(source, ["name"], "2020-01-01 00:00:00", add_ids=False, add_row_number=False)
    assert plain.columns == ["name"]
    full = promoted_rows(source, ["name"], "2020-01-01 00:00:00", order_by=["name"])
    assert rows(full, "name", "bda_origin", "sparkuniqueid") == [("a", "datalake", 1), ("b", "datalake", 2), ("c", "datalake", 3)]
    assert len({r[0] for r in full.select("bda_id").collect()}) == 3
    for _ in range(2):
        assert promote(source, ["name"], "t_promoted", "2020-01-01 00:00:00") == 3
    assert spark.table("t_promoted").columns == ["name", "bda_id", "bda_origin", "sparkuniqueid"]


def test_stats_log(spark, tmp_path):
    counts = spark.createDataFrame([("s", "d", 2, 2, "ds_1"), ("s", "d", 3, 3, "ds_2")], "source string, destination string, record_read int, record_write int, dataset_code string")
    for job in ("publish", "promote"):
        append_stats(stats_rows(counts, job, elapsed_ms=5), str(tmp_path / "stats"))
    assert spark.read.orc(str(tmp_path / "stats")).groupBy("job").agg(F.sum("record_read")).orderBy("job").collect() == [("promote", 5), ("publish", 5)]


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "t", split_column="id", lower=0, upper=10, splits=4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4" and "user" not in options
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", split_column="id")


# ---------------------------------------------------------------- logs


def feed_line(layout: str, **values: str) -> str:
    return ",".join(values.get(name, "-") for name in logs.LAYOUTS[layout])


def test_log_times(spark, tmp_path):
    times = ["2018-10-14T11:41:26.123", "2018-10-14 11:41:26", "-", "", "2018-13-99 00:00:00"]
    (tmp_path / "log.csv").write_text("\n".join(feed_line("esb", log_timestamp=t, uniqueid=str(i)) for i, t in enumerate(times)))
    found = logs.read_feed(spark, str(tmp_path), "esb").orderBy("uniqueid").select("unix_ts", "year", "month", "day").collect()
    assert [tuple(r) for r in found] == [(1539517286, 2018, 10, 14)] * 2 + [(None,) * 4] * 3


def test_layouts_and_feeds_agree():
    assert set(logs.FEEDS.values()) == set(logs.LAYOUTS) and len(logs.FEEDS) == 13
    assert [len(logs.LAYOUTS[k]) for k in ("odata", "amq", "esb", "intapi")] == [17, 13, 12, 14]


def test_failing_feed_does_not_stop_the_others(spark, tmp_path):
    folder = tmp_path / "in" / "site-esbin1"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(feed_line("esb", log_timestamp="2018-10-14 11:41:26"))
    failed = logs.ingest_feeds(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"esbin2": "esb", "esbin1": "esb"}, prefix="site_")
    assert list(failed) == ["site_esbin2"]
    loaded = str(tmp_path / "out" / "site_esbin1_partday")
    assert spark.read.orc(loaded).select("year", "month", "day").first()[:] == (2018, 10, 14)
    # a second run finds nothing new; what a broken run left in its folder is loaded by the next one
    assert logs.ingest_feeds(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"esbin1": "esb"}, prefix="site_") == {}
    assert spark.read.orc(loaded).count() == 1
    (folder / "loading").mkdir(exist_ok=True)
    (folder / "loading" / "b.csv").write_text(feed_line("esb", log_timestamp="2018-10-15 11:41:26"))
    logs.ingest_feeds(spark, str(tmp_path / "in"), str(tmp_path / "out"), {"esbin1": "esb"}, prefix="site_")
    assert spark.read.orc(loaded).count() == 2


@pytest.mark.parametrize("step", ["move", "list", "load", "load twice", "mark", "delete"])
def test_every_line_of_a_feed_is_loaded_once(spark, rows, tmp_path, monkeypatch, step):
    folder, out = tmp_path / "in" / "esbin1", str(tmp_path / "out")
    folder.mkdir(parents=True)
    line = lambda n: feed_line("esb", log_timestamp=f"2018-10-{10 + n} 11:41:26", uniqueid=str(n))
    (folder / "access.csv").write_text(line(1) + "\n" + line(2))
    (folder / "other.csv").write_text(line(3))

    def broken(*_, **__):
        raise OSError("broken off")

    if step == "move":
        real, moved = Files.rename, []
        monkeypatch.setattr("tidemark.files.RENAMES_AT_ONCE", 1)
        monkeypatch.setattr(Files, "rename", lambda self, a, b: broken() if moved else (moved.append(a), real(self, a, b)))
    elif step == "list":
        monkeypatch.setattr(logs.FeedLedger, "list_files", broken)
    elif step in ("load", "load twice"):
        after = logs.replace_batch
        monkeypatch.setattr(logs, "replace_batch", lambda *a: (after(*a) if step == "load twice" else None, broken()))
    elif step == "mark":
        monkeypatch.setattr(logs.FeedLedger, "finish", broken)
    else:
        monkeypatch.setattr(Files, "delete", broken)
    assert logs.ingest_feeds(spark, str(tmp_path / "in"), out, {"esbin1": "esb"}) == {"esbin1": "broken off"}
    monkeypatch.undo()
    (folder / "access.csv").write_text(line(4))  # of the same name as one that may still wait to be loaded
    for _ in range(2):
        assert logs.ingest_feeds(spark, str(tmp_path / "in"), out, {"esbin1": "esb"}) == {}
        assert rows(spark.read.orc(f"{out}/esbin1_partday"), "uniqueid") == [("1",), ("2",), ("3",), ("4",)]
    ledger = logs.FeedLedger(spark, f"{out}/_ledger/esbin1")
    consumed = ledger.consumed()
    assert ledger.open() == [] and sorted(f["path"].rsplit("/", 1)[1] for f in consumed) == ["access.csv", "access.csv", "other.csv"]
    assert all(f["length"] > 0 and f["time"] > 0 for f in consumed) and not list(folder.rglob("*.csv"))


def test_call_pairs_resolve_placeholders(spark, rows, tmp_path):
    lines = [
        feed_line("intapi", log_timestamp="2018-10-14 11:41:26", uniqueid="1", forwardedfor="10.0.0.1", jwt="j", query="q", elapsed="7"),
        feed_line("intapi", log_timestamp="2018-10-14 11:41:27", uniqueid="1", apicode="ds_1", datasetcode="|", tenant="-", nrecout="3"),
        feed_line("intapi", log_timestamp="2018-10-14 11:41:27", uniqueid="2", apicode="ds_1"),
    ]
    (tmp_path / "log.csv").write_text("\n".join(lines))
    known = spark.createDataFrame([("ds_1", "t1"), ("ds_2", "t2")], "datasetcode string, tenantcode string")
    pairs = logs.call_pairs(logs.read_feed(spark, str(tmp_path), "intapi"), known)
    assert rows(pairs, "uniqueid", "forwardedfor", "datasetcode", "tenant", "query", "elapsed", "nrecout", "day") == [
        ("1", "10.0.0.1", "ds_1", "t1", "q", "7", "3", 14)
    ]


def test_append_by_day_splits_folders(spark, tmp_path):
    df = spark.createDataFrame([(1, 2018, 1, 1), (2, 2018, 1, 2), (3, None, None, None)], "x int, year int, month int, day int")
    for _ in range(2):
        append_by_day(df, str(tmp_path / "t"))
    assert spark.read.orc(str(tmp_path / "t")).count() == 6
    assert (tmp_path / "t" / "year=2018" / "month=1" / "day=2").is_dir()


# ---------------------------------------------------------------- streams


def test_log_stream_takes_each_file_once(spark, tmp_path):
    source, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    source.mkdir()
    for number in range(3):
        (source / f"f{number}.csv").write_text(feed_line("amq", log_timestamp="2018-10-14 11:41:26", uniqueid=str(number)))
        stream = log_stream(spark, str(source), "amq", archive=str(tmp_path / "archive"))
        start_log_ingest(stream, target, check).awaitTermination()
        assert spark.read.orc(target).count() == number + 1


def test_incremental_stream_keeps_to_its_range(spark, rows, tmp_path):
    schema = "id string, iddataset_l bigint, datasetversion_l bigint, origin_s string, type_s string"
    source, target, held, check = (str(tmp_path / name) for name in ("docs", "out", "held", "check"))
    state = state_table(spark, str(tmp_path / "state"))
    state.write(spark.createDataFrame([(1, 1, "1" * 24), (2, 1, NEVER_ID)], state.schema))
    datasets = spark.createDataFrame([(i, 1, f"ds{i}", f"{target}/ds{i}") for i in (1, 2)], "iddataset bigint, datasetversion bigint, datasetcode string, folder string")
    found = []
    for arriving, upper in (("0234", "3" * 24), ("5", "3" * 24), ("6", "6" * 24), ("9", "6" * 24), ("8", "7" * 24), ("7", "8" * 24), ("", "9" * 24), ("", "9" * 24)):
        if arriving:
            spark.createDataFrame([(c * 24, d, 1, "speed", c) for c in arriving for d in (1, 2)], schema).coalesce(1).write.mode("append").parquet(source)
        docs = spark.readStream.schema(schema).parquet(source)
        start_incremental_export(docs, datasets, state, held, upper, check).awaitTermination()
        found.append("".join(r[0] for r in rows(read_raw_csv(spark, target, ["type"], recursive=True))))
    # 0 was exported before, 4 and 5 waited for a later upper id, 7 arrived after 8 and 9, and 9 came of age without new files
    assert found == ["23", "23", "23456", "23456", "23456", "2345678", "23456789", "23456789"]
    assert rows(state.read()) == [(1, 1, "9" * 24), (2, 1, NEVER_ID)]
    assert all(name.startswith(tuple(c * 16 for c in "3689")) for name in Files(spark).names(f"{target}/ds1"))
