"""Lake table catalogue: rows and bytes per table, and which tenant owns them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import join_ignoring_case
from tidemark.operators.latest import latest_versions
from tidemark.operators.lists import pivot_params

# Table parameters the catalogue keeps, database name patterns (``_`` is a LIKE wildcard),
# and the catalogue's own tables.
TABLE_PARAMS = ("numRows", "transient_lastDdlTime", "totalSize")
DATABASE_PATTERNS = ("db_%", "transf_%")
CATALOG_TABLES = "db_catalog%"


def name_matches(name: Column, wanted: str) -> Column:
    """Table name test: a LIKE pattern, a comma separated list, one name, or anything when empty."""
    if "," in wanted:
        return name.isin(*[part.strip() for part in wanted.split(",")])
    if wanted == "" or "%" in wanted:
        return name.like(wanted or "%")
    return name == wanted


def ingestion_database(name: Column, excluded: Sequence[str] = ()) -> Column:
    """Databases of ingestion and transformation, without the excluded ones."""
    known = reduce(lambda a, b: a | b, [name.like(pattern) for pattern in DATABASE_PATTERNS])
    return known & ~name.isin(*excluded) if excluded else known


def countable(catalog: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    return catalog.where(ingestion_database(F.col("db_name"), excluded) & ~F.col("tbl_name").like(CATALOG_TABLES))


def catalog_sizes(
    databases: DataFrame, tables: DataFrame, storage: DataFrame, params: DataFrame, tables_wanted: str = "",
    excluded: Sequence[str] = (),
) -> DataFrame:
    """Managed tables of all ingestion databases with row counts and bytes, in one query."""
    managed = tables.where((F.col("tbl_type") != "EXTERNAL_TABLE") & name_matches(F.col("tbl_name"), tables_wanted))
    wide = pivot_params(params, "tbl_id", "param_key", "param_value", TABLE_PARAMS)
    full = (
        databases.where(ingestion_database(F.col("name"), excluded))
        .join(managed, "db_id")
        .join(storage.select("sd_id", "location"), "sd_id", "left")
        .join(wide, "tbl_id")
    )
    return full.select(
        F.col("name").alias("db_name"), "tbl_name",
        F.from_unixtime("create_time", "yyyy-MM-dd HH.mm.ss").alias("creation_date"),
        F.col("location").alias("tb_location"), F.col("numRows").alias("num_rows"),
        F.col("totalSize").alias("total_size"),
    )


def _declared(datasets: DataFrame) -> DataFrame:
    """Lake tables named by the installed latest version of a dataset."""
    last = latest_versions(datasets, "iddataset", "datasetversion").where(F.col("datasetstatus") == "inst")
    return last.select("dbhiveschema", "dbhivetable", "tenantcode")


_SAME_TABLE = [("tbl_name", "dbhivetable"), ("db_name", "dbhiveschema")]


def _sizes(tables: DataFrame, flag: str) -> DataFrame:
    return tables.select(
        "tenantcode", F.col("db_name").alias("dbname"), "tbl_name", "total_size", "num_rows",
        F.lit(flag).alias("flag_approx"),
    )


def owned_tables(catalog: DataFrame, datasets: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Tables a dataset declares, with that dataset's tenant (flag 0)."""
    found = join_ignoring_case(countable(catalog, excluded), _declared(datasets), _SAME_TABLE, "inner")
    return _sizes(found, "0")


def unowned_tables(catalog: DataFrame, datasets: DataFrame, owners: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Tables no dataset declares, given to the tenant of their database (flag 1)."""
    declared = _declared(datasets).select("dbhiveschema", "dbhivetable").distinct()
    free = join_ignoring_case(countable(catalog, excluded), declared, _SAME_TABLE, "left_anti")
    owner = owners.select("tenantcode", F.col("db_hive").alias("db_name"))
    return _sizes(free.join(owner, "db_name", "left"), "1")


def table_sizes(catalog: DataFrame, datasets: DataFrame, owners: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Every countable table with its owner and whether the owner is only approximate.

    The two cases in one pass: tables meet the datasets once, and only those left alone meet the database owners.
    """
    declared = _declared(datasets).withColumnRenamed("tenantcode", "_declared")
    found = join_ignoring_case(countable(catalog, excluded), declared, _SAME_TABLE, "left")
    alone = F.col("dbhivetable").isNull()
    owner = owners.select("tenantcode", "db_hive")
    full = found.join(owner, alone & (F.col("db_name") == F.col("db_hive")), "left")
    tenant = F.when(alone, F.col("tenantcode")).otherwise(F.col("_declared"))
    flag = F.when(alone, F.lit("1")).otherwise(F.lit("0"))
    return full.select(
        tenant.alias("tenantcode"), F.col("db_name").alias("dbname"), "tbl_name", "total_size", "num_rows",
        flag.alias("flag_approx"),
    )
