"""Text clean-up and listing parsers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_comma(value: Column) -> Column:
    return F.translate(value.cast("string"), ".", ",")


def one_line(value: Column) -> Column:
    return F.regexp_replace(value, "\n", " ")


def listing_bytes(line: Column) -> Column:
    """Byte count of a ``bytes <blanks> path`` line, as text."""
    return F.regexp_extract(line, r"^(\S*)\s+(.*)$", 1)


def listing_path(line: Column) -> Column:
    return F.regexp_extract(line, r"^(\S*)\s+(.*)$", 2)


def below(path: Column, root: str) -> Column:
    """Path relative to a root folder."""
    return F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)


def stage_tenant(path: Column) -> Column:
    """Tenant folder right below the stage area; empty when nothing follows it."""
    return F.regexp_extract(path, r"STAGE/([^/]*)/", 1)


def blank_if_undefined(value: Column) -> Column:
    return F.when(value == "undefined", "").otherwise(value)
