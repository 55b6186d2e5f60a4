from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import fieldtypes, objectid, paths, text


def test_every_code_has_a_castable_suffix():
    assert {suffix for suffix, _ in fieldtypes.FIELD_TYPES.values()} == set(fieldtypes.SUFFIX_TYPES)
    with pytest.raises(ValueError):
        fieldtypes.suffix_of("polygon")


def test_suffix_expr_matches_the_map(spark):
    codes = [*fieldtypes.FIELD_TYPES, "polygon"]
    found = spark.createDataFrame([(c,) for c in codes], "code string").select("code", fieldtypes.suffix_expr(F.col("code")))
    expected = {c: fieldtypes.FIELD_TYPES[c][0] if c in fieldtypes.FIELD_TYPES else None for c in codes}
    assert {r[0]: r[1] for r in found.collect()} == expected


def test_document_columns_skip_technical_fields_and_add_stream_columns(spark):
    lake = spark.createDataFrame(
        [("i1", "datalake", datetime(2020, 1, 1), "s", "c", "x", 1)],
        "bda_id string, bda_origin string, bda_time timestamp, bda_sensor string, bda_streamcode string, Name string, sparkuniqueid int",
    )
    fields = [("Name", "string"), ("bda_id", "string"), ("sparkuniqueid", "long")]
    stream = lake.select(*fieldtypes.document_columns(fields, 7, 2, "social"))
    assert stream.columns == [
        "id", "iddataset_l", "datasetversion_l", "origin_s", "time_dt", "sensor_s", "streamcode_s", "name_s"
    ]
    assert lake.select(*fieldtypes.document_columns(fields, 7, 2, "data")).columns == [
        "id", "iddataset_l", "datasetversion_l", "origin_s", "name_s"
    ]


def test_cast_by_suffix_turns_unreadable_text_into_null(spark):
    df = spark.createDataFrame([("x", "1", "2020-02-03 04:05:06", "k")], "a_i string, b_d string, c_dt string, other string")
    assert fieldtypes.cast_by_suffix(df).first()[:] == (None, 1.0, date(2020, 2, 3), "k")
    assert fieldtypes.cast_by_suffix(df, "timestamp").first()["c_dt"] == datetime(2020, 2, 3, 4, 5, 6)
    with pytest.raises(ValueError):
        fieldtypes.cast_by_suffix(df, "week")


def test_schema_from_names_covers_int_and_boolean():
    schema = fieldtypes.schema_from_names(["a_i", "b_b", "c_l", "d_dt", "plain"])
    assert [f.dataType for f in schema] == [
        T.IntegerType(), T.BooleanType(), T.LongType(), T.TimestampType(), T.StringType()
    ]


def test_csv_header_strips_and_refuses_collisions():
    assert fieldtypes.csv_header(["Time_dt", "my_field_s", "plain"]) == ["time", "my_field", "plain"]
    with pytest.raises(ValueError, match="time"):
        fieldtypes.csv_header(["time_dt", "time_s"])


def test_csv_text_rules(spark):
    df = spark.sql("SELECT timestamp'2020-01-01 10:00:00.5' AS t_dt, CAST(NULL AS string) AS a_s, 1.1D AS b_f, CAST(NULL AS int) AS c_i")
    assert fieldtypes.csv_text_columns(df).first()[:] == ("2020-01-01T10:00:00.500Z", "", "1.1", None)
    assert fieldtypes.csv_text_columns(df, "Europe/Rome").first()[0] == "2020-01-01T09:00:00.500Z"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=20))
def test_object_id_keeps_time_and_order(spark, seconds):
    df = spark.createDataFrame([(s,) for s in seconds], "s bigint").select("s", objectid.id_from_seconds(F.col("s")).alias("oid"))
    found = df.select("s", "oid", objectid.id_seconds(F.col("oid"))).collect()
    assert all(s == back and len(oid) == 24 for s, oid, back in found)
    assert sorted(found, key=lambda r: r["s"]) == sorted(found, key=lambda r: (r["oid"], r["s"]))


def test_upper_bound_and_part_ids(spark):
    one = spark.range(1).select(
        objectid.upper_bound_id(F.lit("2024-01-01 00:07:00").cast("timestamp")).alias("upper"),
        objectid.part_id(F.lit("65a7c9dc" + "1" * 16), F.lit(0)).alias("p0"),
        objectid.part_id(F.lit("65a7c9dc" + "1" * 16), F.lit(10)).alias("p10"),
        objectid.id_month(F.lit(objectid.NEVER_ID)).alias("month"), objectid.id_year(F.lit(objectid.NEVER_ID)).alias("year"),
    ).first()
    assert one["upper"] == f"{1704067200:08x}" + "0" * 16
    assert one["p0"] == "65a7c9dc" + "1" * 16 and one["p10"] == "65a7c9dc" + "1" * 8 + "0000000a"
    assert (one["year"], one["month"]) == (2099, 12)


def test_month_follows_the_time_zone(spark):
    last_hour = objectid.id_from_time(F.lit("2024-01-31 23:30:00").cast("timestamp"))
    assert spark.range(1).select(objectid.id_month(last_hour), objectid.id_month(last_hour, "Europe/Rome")).first()[:] == (1, 2)


def test_folder_rules(spark):
    df = spark.createDataFrame(
        [("bulkDataset", "org", "dom", "", None, "ds", None), ("streamDataset", "org", "dom", "sub", "my slug/1", "ds", "st")],
        "sub string, org string, dom string, subdom string, slug string, code string, stream string",
    )
    folder = paths.dataset_folder(*[F.col(c) for c in ("sub", "org", "dom", "subdom", "slug", "code", "stream")])
    assert [r[0] for r in df.select(folder).collect()] == [
        "/datalake/ORG/rawdata/DOM/db_DOM/ds", "/datalake/ORG/rawdata/DOM/so_my-slug-1/st"
    ]


def test_file_names_round_trip(spark):
    name = paths.export_file_name(F.lit("a" * 24), F.lit(12), F.lit("ds-a_1-x"), F.lit(3))
    parts = paths.parse_file_name(name)
    row = spark.range(1).select(name.alias("n"), *[c.alias(k) for k, c in parts.items()]).first()
    assert row[:] == (f"{'a' * 24}_12-ds-a_1-x-3.csv", "a" * 24, 12, "ds-a_1-x", 3)
    other = paths.parse_file_name(F.lit("part-0000.csv"))
    assert spark.range(1).select(*other.values()).first()[:] == (None, None, None, None)


def test_default_collection(spark):
    args = [F.lit(x) for x in ("d", "m", "s", "x")]
    df = spark.createDataFrame([("data",), ("measures",), ("social",), ("media",)], "f string")
    assert [r[0] for r in df.select(paths.default_collection(F.col("f"), *args)).collect()] == ["d", "m", "s", "x"]
    assert df.select(paths.default_collection(F.col("f"), *args, forced="own")).first()[0] == "own"


def test_text_helpers(spark):
    row = spark.range(1).select(
        text.decimal_comma(F.lit(1.5)), text.one_line(F.lit("a\nb")), text.listing_bytes(F.lit("12   /a/b c")),
        text.listing_path(F.lit("12   /a/b c")), text.below(F.lit("/user/store/coll"), "/user/store/"),
        text.stage_tenant(F.lit("/x/STAGE/t1/files")), text.stage_tenant(F.lit("/x/STAGE/readme")),
        text.blank_if_undefined(F.lit("undefined")), text.blank_if_undefined(F.lit(None).cast("string")),
    ).first()
    assert row[:] == ("1,5", "a b", "12", "/a/b c", "coll", "t1", "", "", None)
