"""Nested metadata documents: tenants, datasets and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.paths import clean_slug, subdomain_or_domain


def not_deleted() -> Column:
    return F.coalesce(F.col("configData.deleted"), F.lit(0)) == 0


def tenant_collections(tenants: DataFrame) -> DataFrame:
    """Tenant descriptor: organization and the default serving collection of every data family."""
    return tenants.select(
        "tenantCode",
        "organizationCode",
        F.col("dataSolrCollectionName").alias("collection_data"),
        F.col("measuresSolrCollectionName").alias("collection_measures"),
        F.col("socialSolrCollectionName").alias("collection_social"),
        F.col("mediaSolrCollectionName").alias("collection_media"),
    )


def live_documents(datasets: DataFrame) -> DataFrame:
    """Dataset documents that are not binary and not deleted."""
    return datasets.where((F.col("configData.subtype") != "binaryDataset") & not_deleted())


def publishable_documents(datasets: DataFrame) -> DataFrame:
    """Live, current documents available to the serving store."""
    return live_documents(datasets).where(F.col("availableSpeed") & (F.col("configData.current") == 1))


def dataset_streams(streams: DataFrame) -> DataFrame:
    """Stream code and cleaned slug per tenant and dataset version."""
    return streams.select(
        F.col("configData.tenantCode").alias("tenantCode"),
        F.col("configData.idDataset").alias("idDataset"),
        F.col("configData.datasetVersion").alias("datasetVersion"),
        "streamCode",
        clean_slug(F.col("streams.stream.virtualEntitySlug")).alias("vESlug"),
    )


def document_descriptors(datasets: DataFrame, streams: DataFrame) -> DataFrame:
    """Flat dataset descriptors from publishable documents and their streams.

    A dataset version has one stream; should documents repeat it, the smallest pair is taken.
    """
    flat = publishable_documents(datasets).select(
        "idDataset", "datasetVersion", "datasetCode", "availableSpeed",
        F.col("configData.subtype").alias("subType"),
        F.col("configData.tenantCode").alias("tenantCode"),
        F.col("info.dataDomain").alias("dataDomain"),
        subdomain_or_domain(F.col("info.codSubDomain"), F.col("info.dataDomain")).alias("codSubDomain"),
        F.transform(
            "info.fields", lambda f: F.struct(f["fieldName"].alias("fieldName"), f["dataType"].alias("dataType"))
        ).alias("campi"),
    )
    keys = ["tenantCode", "idDataset", "datasetVersion"]
    one = F.min(F.struct("streamCode", "vESlug")).alias("s")
    described = flat.join(dataset_streams(streams).groupBy(*keys).agg(one), keys, "left")
    streaming = F.col("subType").isin("streamDataset", "socialDataset")
    return described.select(
        *flat.columns,
        F.when(streaming, F.col("s.streamCode")).alias("streamCode"),
        F.when(streaming, F.col("s.vESlug")).alias("vESlug"),
    )
