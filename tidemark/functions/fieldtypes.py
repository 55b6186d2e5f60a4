"""Logical field types, the physical name suffixes that carry them, and the casts they imply."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Logical type code -> (column suffix, SQL type name).
FIELD_TYPES = {
    "boolean": ("_b", "BOOLEAN"),
    "string": ("_s", "VARCHAR"),
    "int": ("_i", "INTEGER"),
    "long": ("_l", "BIGINT"),
    "double": ("_d", "DOUBLE"),
    "data": ("_dt", "TIMESTAMP"),
    "date": ("_dt", "TIMESTAMP"),
    "datetimeOffset": ("_dt", "TIMESTAMP"),
    "datetime": ("_dt", "TIMESTAMP"),
    "dateTime": ("_dt", "TIMESTAMP"),
    "time": ("_dt", "TIMESTAMP"),
    "float": ("_f", "FLOAT"),
    "longitude": ("_d", "DOUBLE"),
    "latitude": ("_d", "DOUBLE"),
    "binary": ("_s", "VARCHAR"),
    "bigdecimal": ("_d", "DOUBLE"),
}

# Column suffix -> Spark type of a serving document field.
SUFFIX_TYPES = {
    "_b": T.BooleanType(),
    "_s": T.StringType(),
    "_i": T.IntegerType(),
    "_l": T.LongType(),
    "_d": T.DoubleType(),
    "_dt": T.TimestampType(),
    "_f": T.FloatType(),
}

# Columns added by the platform, never part of a dataset's own fields.
TECHNICAL_FIELDS = ("bda_id", "bda_origin", "sparkuniqueid")
STREAM_FAMILIES = ("measures", "social")
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def suffix_of(code: str) -> str:
    try:
        return FIELD_TYPES[code][0]
    except KeyError:
        raise ValueError(f"unknown field type code {code!r}") from None


def suffix_expr(code: Column) -> Column:
    """Suffix of a type code held in a column; null for an unknown code."""
    pairs = chain.from_iterable((F.lit(name), F.lit(suffix)) for name, (suffix, _) in FIELD_TYPES.items())
    return F.try_element_at(F.create_map(*pairs), code)


def suffix_in(name: str) -> str | None:
    """The type suffix a serving column name ends with."""
    found = re.search(r"_[a-z]+$", name)
    return found.group() if found and found.group() in SUFFIX_TYPES else None


def field_columns(fields: Iterable[tuple[str, str]]) -> list[Column]:
    """Dataset fields renamed to their suffixed, lower-case serving names."""
    own = [(name.lower(), code) for name, code in fields if name.lower() not in TECHNICAL_FIELDS]
    return [F.col(f"`{name}`").alias(name + suffix_of(code)) for name, code in own]


def document_fields(fields: Iterable[tuple[str, str]], family: str) -> list[tuple[str, T.DataType]]:
    """Serving names and types of a dataset's own columns."""
    names = ["time_dt", "sensor_s", "streamcode_s"] if family in STREAM_FAMILIES else []
    names += [name.lower() + suffix_of(code) for name, code in fields if name.lower() not in TECHNICAL_FIELDS]
    return [(name, SUFFIX_TYPES[suffix_in(name)]) for name in names]


def document_columns(
    fields: Iterable[tuple[str, str]], dataset_id: int | Column, version: int | Column, family: str
) -> list[Column]:
    """Full column list of a serving document built from a lake row."""

    def value(x: int | Column) -> Column:
        return (x if isinstance(x, Column) else F.lit(x)).cast("bigint")

    columns = [
        F.col("bda_id").alias("id"),
        value(dataset_id).alias("iddataset_l"),
        value(version).alias("datasetversion_l"),
        F.col("bda_origin").alias("origin_s"),
    ]
    if family in STREAM_FAMILIES:
        columns += [
            F.col("bda_time").alias("time_dt"),
            F.col("bda_sensor").alias("sensor_s"),
            F.col("bda_streamcode").alias("streamcode_s"),
        ]
    return columns + field_columns(fields)


def cast_by_suffix(df: DataFrame, dt_as: str = "date") -> DataFrame:
    """Cast every suffixed column to its serving type; unreadable text becomes null, other columns pass through.

    ``dt_as="date"`` drops the time of day as publishing always did; ``"timestamp"`` keeps it.
    """
    if dt_as not in ("date", "timestamp"):
        raise ValueError(f"dt_as must be date or timestamp, not {dt_as!r}")
    present = dict(df.dtypes)

    def convert(name: str) -> Column:
        suffix = suffix_in(name)
        column = F.col(f"`{name}`")
        if suffix is None:
            return column
        if suffix == "_dt":
            moment = column.try_cast("timestamp") if present[name] == "string" else column
            return moment.cast(dt_as).alias(name)
        return column.try_cast(SUFFIX_TYPES[suffix]).alias(name)

    return df.select(*[convert(name) for name in df.columns])


def schema_from_names(names: Sequence[str]) -> T.StructType:
    """Schema read off the column suffixes, for stores that cannot describe themselves."""
    return T.StructType([T.StructField(n, SUFFIX_TYPES.get(suffix_in(n), T.StringType())) for n in names])


def apply_suffix_schema(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Type an all-text frame by its column suffixes."""
    schema = schema_from_names(names or df.columns)
    return df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])


def csv_text_columns(df: DataFrame, time_zone: str = "UTC") -> DataFrame:
    """Text rules of the CSV export: ISO-UTC times, empty text for null text, floats at single precision."""

    def render(name: str) -> Column:
        column = F.col(f"`{name}`")
        if name.endswith("_dt"):
            return F.date_format(F.to_utc_timestamp(column.cast("timestamp"), time_zone), ISO_UTC).alias(name)
        if name.endswith("_s"):
            return F.coalesce(column, F.lit("")).alias(name)
        if name.endswith("_f"):
            return column.cast("float").cast("string").alias(name)
        return column

    return df.select(*[render(name) for name in df.columns])


def csv_header(columns: Sequence[str]) -> list[str]:
    """Header names: lower case without the last ``_xxx`` part. Two fields sharing a name are an error."""
    header = [re.sub(r"_[^_]+$", "", name.lower()) for name in columns]
    repeated = sorted({name for name in header if header.count(name) > 1})
    if repeated:
        raise ValueError(f"columns collide after removing the type suffix: {repeated}")
    return header
