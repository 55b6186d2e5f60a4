"""Which datasets a job may touch.

Input: one row per dataset version with iddataset, datasetversion, datasetcode, sottotipo, datasetstatus_desc,
availablespeed, tenantcode, ... A request (tenants, ids, groups) is a frame too, so any number is served at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Identity of the lake as a source, and the catalogue codes the rules test.
LAKE_SOURCE_URL = "datalake"
LAKE_SOURCE_TYPE = "HIVE"
BINARY_SUBTYPE_ID = 3
UNINSTALLED_STATUS_ID = 5


class NotEligible(ValueError):
    """A requested dataset may not be processed."""


def installed() -> Column:
    return F.col("datasetstatus_desc") == "installed"


def not_binary() -> Column:
    return F.col("sottotipo") != "binaryDataset"


def speed_ready() -> Column:
    return F.col("availablespeed") & not_binary() & installed()


def lake_sourced(source_url: str = LAKE_SOURCE_URL) -> Column:
    """Transformed in the lake, hence promotable."""
    return (F.col("jdbcdburl") == source_url) & (F.col("jdbcdbtype") == LAKE_SOURCE_TYPE) & F.col("istransformed")


def _requested(datasets: DataFrame, request: DataFrame | None, on: list[str]) -> DataFrame:
    return datasets if request is None else datasets.join(request.select(*on).distinct(), on, "left_semi")


def by_tenant(datasets: DataFrame, tenants: DataFrame | None = None) -> DataFrame:
    return _requested(datasets, tenants, ["tenantcode"]).where(speed_ready())


def eligibility(datasets: DataFrame, rule: Column) -> DataFrame:
    """The datasets with the rule's verdict; an unknown verdict is a refusal."""
    return datasets.withColumn("eligible", F.coalesce(rule, F.lit(False)))


def by_id(datasets: DataFrame, ids: DataFrame | None = None, rule: Column | None = None) -> DataFrame:
    """Requested datasets with the verdict on each."""
    return eligibility(_requested(datasets, ids, ["iddataset"]), speed_ready() if rule is None else rule)


def require_eligible(judged: DataFrame) -> DataFrame:
    """Fail when any requested dataset was refused."""
    refused = judged.where(~F.col("eligible")).select("iddataset").take(5)
    if refused:
        raise NotEligible(f"not eligible: {[row['iddataset'] for row in refused]}")
    return judged.drop("eligible")


def by_group(
    datasets: DataFrame, members: DataFrame, to_lake: bool, to_serving: bool, source_url: str = LAKE_SOURCE_URL
) -> DataFrame:
    """Datasets of groups (idgroup, groupversion, iddataset), under the rules of the chosen destinations."""
    if not (to_lake or to_serving):
        raise ValueError("choose the lake, the serving store or both")
    rule = not_binary() & installed()
    if to_serving:
        rule &= F.col("availablespeed")
    if to_lake:
        rule &= lake_sourced(source_url)
    return members.join(datasets.where(rule), "iddataset")


def promotable(datasets: DataFrame, ids: DataFrame | None = None, source_url: str = LAKE_SOURCE_URL) -> DataFrame:
    return by_id(datasets, ids, lake_sourced(source_url))


def exportable(datasets: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Incremental export: not binary, not uninstalled, by catalogue number."""
    rule = (F.col("idsubtype") != BINARY_SUBTYPE_ID) & (F.col("idstatus") != UNINSTALLED_STATUS_ID)
    return _requested(datasets, codes, ["datasetcode"]).where(rule)


def compactable(datasets: DataFrame, codes: DataFrame | None = None, organizations: DataFrame | None = None) -> DataFrame:
    """Compaction: neither bulk nor binary."""
    chosen = _requested(_requested(datasets, codes, ["datasetcode"]), organizations, ["organizationcode"])
    return chosen.where((F.col("sottotipo") != "bulkDataset") & not_binary())
