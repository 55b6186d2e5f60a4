"""24-digit hexadecimal object ids whose first 8 digits are the unix time, so text order is time order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Id used when a dataset was never exported, and the 2099 id that switches incremental export off.
FIRST_ID = "0" * 24
NEVER_ID = "f48648f00000000000000000"


def id_seconds(oid: Column) -> Column:
    return F.conv(F.substring(oid, 1, 8), 16, 10).cast("bigint")


def id_time(oid: Column, time_zone: str = "UTC") -> Column:
    return F.from_utc_timestamp(F.timestamp_seconds(id_seconds(oid)), time_zone)


def id_year(oid: Column, time_zone: str = "UTC") -> Column:
    return F.year(id_time(oid, time_zone))


def id_month(oid: Column, time_zone: str = "UTC") -> Column:
    return F.month(id_time(oid, time_zone))


def id_from_seconds(seconds: Column, low: Column | None = None) -> Column:
    """Id of a unix time; ``low`` fills the 16 low digits (zero when left out)."""
    high = F.lpad(F.lower(F.hex(seconds.cast("bigint"))), 8, "0")
    if low is None:
        return F.concat(high, F.lit("0" * 16))
    return F.concat(high, F.lpad(F.lower(F.hex(low.cast("bigint"))), 16, "0"))


def id_from_time(moment: Column, low: Column | None = None) -> Column:
    return id_from_seconds(F.unix_seconds(moment.cast("timestamp")), low)


def upper_bound_id(as_of: Column, grace_minutes: int = 7) -> Column:
    """Upper id of a run: rows younger than the grace are left for the next run."""
    return id_from_seconds(F.unix_seconds(as_of.cast("timestamp")) - 60 * grace_minutes)


def part_id(oid: Column, part: Column) -> Column:
    """Id for the n-th file of one export: the same second, the part number in the low digits."""
    numbered = F.concat(F.substring(oid, 1, 16), F.lpad(F.lower(F.hex(part.cast("bigint"))), 8, "0"))
    return F.when(part == 0, oid).otherwise(numbered)
