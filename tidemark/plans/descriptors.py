"""Dataset descriptors: everything a job needs to know about a dataset, one row per version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.fieldtypes import suffix_expr
from tidemark.functions.paths import clean_slug, dataset_folder, family, subdomain_or_domain


def with_paths(datasets: DataFrame, root: str = "/datalake", prefix: str = "") -> DataFrame:
    """Add family, subdomain default, cleaned slug and raw-data folder."""
    folder = dataset_folder(
        F.col("sottotipo"), F.col("organizationcode"), F.col("datadomain"), F.col("codsubdomain"), F.col("slug"),
        F.col("datasetcode"), F.col("streamcode"), root, prefix,
    )
    return datasets.select(
        *[c for c in datasets.columns if c not in ("codsubdomain", "slug")],
        family(F.col("sottotipo")).alias("family"),
        subdomain_or_domain(F.col("codsubdomain"), F.col("datadomain")).alias("codsubdomain"),
        clean_slug(F.col("slug")).alias("slug"),
        folder.alias("folder"),
    )


def field_lists(components: DataFrame) -> DataFrame:
    """Fields of each dataset version in their stored order: campi array<struct<fieldName,dataType>>.

    A dataset's fields are the columns of one table, so the list is as long as a table is wide.
    """
    entry = F.struct("position", F.lower("name").alias("fieldName"), F.col("datatype").alias("dataType"))
    listed = components.groupBy("iddataset", "datasetversion").agg(F.array_sort(F.collect_set(entry)).alias("_entries"))
    plain = F.transform("_entries", lambda e: F.struct(e["fieldName"].alias("fieldName"), e["dataType"].alias("dataType")))
    return listed.select("iddataset", "datasetversion", plain.alias("campi"))


def descriptors(datasets: DataFrame, components: DataFrame, streams: DataFrame, root: str = "/datalake") -> DataFrame:
    """Datasets with their field list and, for streams and social data, stream code and smart-object slug."""
    keys = ["iddataset", "datasetversion"]
    full = datasets.join(field_lists(components), keys, "left").join(streams.select(*keys, "streamcode", "slug"), keys, "left")
    streaming = F.col("sottotipo").isin("streamDataset", "socialDataset")
    for name in ("streamcode", "slug"):
        full = full.withColumn(name, F.when(streaming, F.col(name)))
    return with_paths(full, root)


def serving_names(campi: str = "campi"):
    """Comma list of the suffixed serving columns of a field list."""
    return F.array_join(F.transform(campi, lambda f: F.concat(f["fieldName"], suffix_expr(f["dataType"]))), ",")
