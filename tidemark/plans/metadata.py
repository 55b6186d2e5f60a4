"""Metadata marts: tenants, streams, datasets and APIs denormalized from the catalogue's tables.

``src`` maps the normalized table names (tenant, organization, data_source, dataset, stream, ...) to frames.
Dimension tables join on their keys and are broadcast by Spark when they are small enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lists import comma_list

Tables = dict[str, DataFrame]
SOURCE = ["id_data_source", "datasourceversion"]

# Size columns of the tenant mart that are always zero, in their order.
ZERO_SIZES = (
    "colldatasize", "colldataindexsize", "collmeasuressize", "collmeasuresindexsize", "collsocialsize",
    "collsocialindexsize", "collmediasize", "collmediaindexsize", "collarchivedatasize", "collarchivedataindexsize",
    "collarchivemeasuressize", "collarchivemeasuresindexsize", "colltotaldbsize", "colltotaldbindexsize",
)


def mart_tenant(src: Tables) -> DataFrame:
    full = (
        src["tenant"].withColumnRenamed("description", "descrtenant")
        .join(src["organization"].select("id_organization", "organizationcode"), "id_organization")
        .join(src["tenant_type"], "id_tenant_type")
        .join(src["tenant_status"], "id_tenant_status")
        .join(src["tenant_bundle"], "id_tenant")
        .join(src["bundle"], "id_bundles")
    )
    zeros = [F.lit(0).alias(name) for name in ZERO_SIZES[:12]]
    totals = [F.lit(0).alias(name) for name in ZERO_SIZES[12:]]
    return full.select(
        "tenantcode", F.col("name").alias("tenantname"), F.col("id_tenant").alias("idtenant"), "descrtenant",
        "organizationcode", F.col("tenanttypecode").alias("tenanttype"),
        F.col("tenantstatuscode").alias("coddeploymentstatus"), F.col("activationdate").alias("dataattivazione"),
        F.col("id_ecosystem").alias("idecosystem"), "username", "userlastname", "userfirstname", "useremail",
        "usertypeauth", *zeros, F.lit("").alias("databasenames"), *totals,
        F.col("deactivationdate").alias("datadisattivazione"), "hasstage", "zeppelin",
    )


def _managed_sources(src: Tables, components: str) -> DataFrame:
    """Data sources with their managing tenant and the comma lists of component names, tags and sharing tenants.

    Everything here is keyed by data source and version, so one partitioning serves all the joins. Tenants, of whom there may
    be too many to broadcast, meet the narrow relations once, and managers come from the same rows as the sharing tenants.
    """
    tenants = src["tenant"].select("id_tenant", "tenantcode")
    relations = src["tenant_data_source"].where(F.col("isactive") == 1).select(*SOURCE, "id_tenant", "ismanager").join(tenants, "id_tenant")
    manager = F.when(F.col("ismanager") == 1, F.struct(F.col("id_tenant").alias("idtenant"), "tenantcode"))
    # dealt out as rows, which are smaller than the lists that tasks would make of the few they see
    shares = comma_list(relations.repartition(*SOURCE), SOURCE, "tenantcode", "elencoshare", F.collect_list(manager).alias("_managers"))
    managed = shares.select(*SOURCE, "elencoshare", F.inline("_managers"))
    tags = src["source_tag"].join(src["tag"], "id_tag")
    return (
        src["data_source"]
        .join(managed, SOURCE)
        .join(comma_list(src["component"], SOURCE, "name", components), SOURCE, "left")
        .join(comma_list(tags, SOURCE, "tagcode", "elencotag"), SOURCE, "left")
    )


def _described(sources: DataFrame, src: Tables) -> DataFrame:
    """Add status, domain and, where set, licence."""
    return (
        sources.join(src["status"], "id_status")
        .join(src["subdomain"], "id_subdomain")
        .join(src["domain"], "id_domain")
        .join(src["license"], "id_license", "left")
    )


def mart_stream(src: Tables) -> DataFrame:
    objects = (
        src["smart_object"].join(src["so_type"], "id_so_type").join(src["so_category"], "id_so_category")
        .withColumnsRenamed({"name": "so_name", "description": "so_description"})
    )
    keyed = _managed_sources(src, "elencocomponent").join(src["stream"], SOURCE).join(
        src["dataset"].select(*SOURCE, "iddataset"), SOURCE, "left"
    )
    full = _described(keyed, src).join(objects, "id_smart_object")
    return full.select(
        "idstream", "streamcode", "streamname", "idtenant", "tenantcode", "iddataset",
        F.when(F.col("iddataset").isNotNull(), F.col("datasourceversion")).alias("datasetversion"),
        F.col("id_smart_object").alias("idvirtualentity"), F.col("id_so_category").alias("idcategoriave"),
        F.col("id_so_type").alias("idtipove"), F.col("so_name").alias("virtualentityname"),
        F.col("so_description").alias("descrve"), F.col("socode").alias("virtualentitycode"),
        F.col("sotypecode").alias("virtualentitytype"), F.col("socategorycode").alias("virtualentitycategory"),
        F.col("statuscode").alias("streamstatus"), F.col("domaincode").alias("domainstream"),
        F.col("licensecode").alias("licence"), "visibility", F.lit("true").alias("publishstream"),
        "elencocomponent", "elencotag", "elencoshare", F.col("slug").alias("virtualentityslug"),
    )


def _datasets(src: Tables) -> DataFrame:
    """Shared part of the two dataset marts."""
    newest = src["data_source"].groupBy("id_data_source").agg(F.max("datasourceversion").alias("datasourceversion"))
    binaries = src["dataset"].groupBy(F.col("id_data_source").alias("id_data_source_binary")).agg(
        F.max("iddataset").alias("binaryiddataset")
    )
    # by data source and version, because the finished rows are wide
    attached = src["dataset"].select(*SOURCE, "id_data_source_binary").join(binaries, "id_data_source_binary")
    pair = F.struct("id_data_source_binary", "binaryiddataset")
    attached = attached.groupBy(*SOURCE).agg(F.map_from_entries(F.collect_set(pair)).alias("_binaries"))
    own = src["dataset"].withColumnRenamed("description", "descrds").join(attached, SOURCE, "left")
    own = own.withColumn("binaryiddataset", F.col("_binaries")[F.col("id_data_source_binary")]).drop("_binaries")
    # marked by data source and version as well: only the newest versions' keys are dealt out, not the sources
    keyed = _managed_sources(src, "elencocampi").join(own, SOURCE).join(newest.withColumn("_newest", F.lit(True)), SOURCE, "left")
    return (
        _described(keyed, src)
        .join(src["dataset_type"], "id_dataset_type")
        .join(src["dataset_subtype"], "id_dataset_subtype")
    )


def _dataset_columns() -> list[Column]:
    is_installed = F.coalesce(F.col("statuscode") == "inst", F.lit(False))
    current = F.col("_newest").isNotNull() & is_installed
    return [
        F.col("iddataset"), F.col("datasetcode"), F.col("datasourceversion").cast("int").alias("datasetversion"),
        F.col("idtenant"), F.col("tenantcode"), F.col("dataset_type").alias("tipo"),
        F.col("dataset_subtype").alias("sottotipo"), F.col("phoenixtablename").alias("tabella"),
        F.col("statuscode").alias("datasetstatus"), F.when(current, 1).otherwise(0).alias("corrente"),
        F.col("datasetname"), F.col("descrds"), F.col("licensecode").alias("license"), F.col("visibility"),
        F.col("domaincode").alias("datadomain"), F.col("binaryiddataset"),
        F.col("datasourceversion_binary").alias("binarydatasetversion"), F.col("isopendata").alias("openflag"),
        F.col("opendataauthor").alias("openauthor"), F.col("elencocampi"), F.col("elencotag"), F.col("elencoshare"),
        F.col("subdomaincode").alias("codsubdomain"), F.when(is_installed, "false").otherwise("true").alias("deleted"),
    ]


def mart_dataset(src: Tables) -> DataFrame:
    return _datasets(src).select(*_dataset_columns())


def mart_dataset_extended(src: Tables) -> DataFrame:
    """The dataset mart with the serving names, defaulted from the organization by subtype."""

    def own_or_default(name: str) -> Column:
        kind = F.col("dataset_subtype")
        default = (
            F.when(kind == "bulkDataset", F.col(f"data{name}"))
            .when(kind == "socialDataset", F.col(f"social{name}"))
            .when(kind == "streamDataset", F.col(f"measures{name}"))
            .otherwise(F.col(f"media{name}"))
        )
        return F.coalesce(F.col(name), default).alias(name)

    serving = [own_or_default(name) for name in ("solrcollectionname", "phoenixtablename", "phoenixschemaname")]
    full = _datasets(src).join(src["organization"].drop("organizationcode"), "id_organization")
    return full.select(*_dataset_columns(), *serving, "dbhiveschema", "dbhivetable")


def mart_api(src: Tables) -> DataFrame:
    objects = src["smart_object"].select("id_smart_object", "socode")
    streams = src["stream"].select(*SOURCE, "idstream", "streamcode", "id_smart_object").join(objects, "id_smart_object", "left")
    owners = src["tenant_data_source"].select(*SOURCE, "id_tenant").join(src["tenant"].select("id_tenant", "tenantcode"), "id_tenant")
    full = (
        src["api"].join(src["data_source"].select(*SOURCE), SOURCE)
        .join(src["dataset"].select(*SOURCE, "iddataset"), SOURCE, "left")
        .join(streams, SOURCE, "left")
        .join(owners, SOURCE)
    )
    return full.select(
        "idapi", "apiname", "apicode", "id_tenant", "tenantcode", "apitype", "apisubtype", "entitynamespace",
        "iddataset", "datasourceversion", "idstream", "streamcode", "socode",
    )
