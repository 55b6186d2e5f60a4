"""Folder and file naming rules of the raw-data area, as column expressions over dataset descriptors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FILE_NAME = r"^([0-9a-f]{24})_([0-9]+)-(.+)-([0-9]+)\.csv$"


def family(subtype: Column) -> Column:
    """Data family of a dataset subtype."""
    return (
        F.when(subtype == "bulkDataset", "data").when(subtype == "socialDataset", "social").otherwise("measures")
    )


def subdomain_or_domain(subdomain: Column, domain: Column) -> Column:
    return F.coalesce(F.nullif(subdomain, F.lit("")), domain)


def clean_slug(slug: Column) -> Column:
    return F.regexp_replace(slug, "[^a-zA-Z0-9-_]", "-")


def dataset_folder(
    subtype: Column, organization: Column, domain: Column, subdomain: Column, slug: Column,
    dataset_code: Column, stream_code: Column, root: str = "/datalake", prefix: str = "",
) -> Column:
    """Raw-data folder of a dataset; bulk data is filed by subdomain, everything else by smart object."""
    is_bulk = subtype == "bulkDataset"
    group = F.when(
        is_bulk, F.concat(F.lit("db_"), F.upper(subdomain_or_domain(subdomain, domain)))
    ).otherwise(F.concat(F.lit("so_"), F.coalesce(clean_slug(slug), F.lit(""))))
    leaf = F.when(is_bulk, dataset_code).otherwise(stream_code)
    top = F.concat(F.lit(f"{root}/{prefix}"), F.upper(organization), F.lit("/rawdata/"), F.upper(domain))
    return F.concat_ws("/", top, group, leaf)


def export_file_name(oid: Column, rows: Column, dataset_code: Column, version: Column) -> Column:
    return F.concat(
        oid, F.lit("_"), rows.cast("string"), F.lit("-"), dataset_code, F.lit("-"), version.cast("string"), F.lit(".csv")
    )


def work_name(dataset_id: Column, version: Column) -> Column:
    """Name of the unpublished export of a dataset."""
    return F.format_string("_%05d-%03d.csv.tmp", dataset_id, version)


def parse_file_name(name: Column) -> dict[str, Column]:
    """Parts of a raw CSV name; all null when the name does not follow the rule."""
    matches = name.rlike(FILE_NAME)

    def part(n: int) -> Column:
        return F.when(matches, F.regexp_extract(name, FILE_NAME, n))

    return {
        "oid": part(1),
        "file_rows": part(2).cast("bigint"),
        "datasetcode": part(3),
        "datasetversion": part(4).cast("int"),
    }


def default_collection(
    family_name: Column, data: Column, measures: Column, social: Column, media: Column, forced: str = "none"
) -> Column:
    """Serving collection of a tenant by family; a forced name wins unless it is ``none``."""
    if forced.lower() != "none":
        return F.lit(forced)
    return (
        F.when(family_name == "measures", measures)
        .when(family_name == "data", data)
        .when(family_name == "social", social)
        .when(family_name == "media", media)
    )
