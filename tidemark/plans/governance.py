"""Governance marts: what every tenant stores, calls and owns.

Facts are aggregated per tenant before they meet the tenant table, so a tenant holding most of the datasets
costs one combined row per task instead of a join on its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import blank_if_undefined, one_line
from tidemark.operators.joins import join_all, join_on_code_suffix
from tidemark.operators.latest import latest_versions

# Descriptive tenant columns, the time at or before which a last update counts as missing,
# the seconds of the reference month, the domain of datasets that span several.
TENANT_KEYS = [
    "idecosystem", "tenanttype", "organizationcode", "coddeploymentstatus", "tenantname", "tenantcode",
    "userlastname", "userfirstname", "useremail", "zeppelin", "hasstage", "dataattivazione", "datadisattivazione",
]
EPOCH_SENTINEL = "1970-01-01 01:00:00"
SECONDS_PER_MONTH = 30 * 24 * 60 * 60
SHARED_DOMAIN = "MULTI"


def megabytes(size: Column) -> Column:
    return F.round(size / (1024 * 1024), 1)


def _per_tenant(tenants: DataFrame, facts: DataFrame, defaults: dict) -> DataFrame:
    """Every tenant code once, as ``tenant``, with its facts or the defaults."""
    codes = tenants.select("tenantcode").distinct()
    return codes.join(facts, "tenantcode", "left").fillna(defaults).withColumnRenamed("tenantcode", "tenant")


def collection_records(datasets: DataFrame, serving: DataFrame) -> DataFrame:
    """Records of each tenant in each collection, and when the last of them came: one join of the dataset versions with the
    serving store, for all that needs no more than these sums."""
    version = ["iddataset", "datasetversion"]
    served = datasets.select("tenantcode", "solrcollectionname", *version).join(serving.select(*version, "numrecord", "lasttimeid"), version, "left")
    return served.groupBy("tenantcode", "solrcollectionname").agg(F.sum("numrecord").alias("numrecord"), F.max("lasttimeid").alias("lasttimeid"))


def tenant_info(tenants: DataFrame, datasets: DataFrame, serving: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Descriptive tenant card with the date of the last update in the serving store.

    ``records`` are the ``collection_records`` of the datasets, where they have been written down."""
    version = ["iddataset", "datasetversion"]
    updated = datasets.select("tenantcode", *version).join(serving, version) if records is None else records
    last = updated.groupBy("tenantcode").agg(F.max("lasttimeid").alias("_last"))
    known = F.when(F.col("_last") > F.lit(EPOCH_SENTINEL).cast("timestamp"), F.col("_last").cast("date").cast("string"))
    return tenants.select(*TENANT_KEYS).distinct().join(last, "tenantcode", "left").select(
        "idecosystem", "tenanttype", "organizationcode", "tenantname", "tenantcode",
        F.concat("userlastname", F.lit(" "), "userfirstname").alias("referente"),
        F.col("useremail").alias("email_referente"), known.alias("dataultimoaggiornamento"),
        blank_if_undefined(F.col("zeppelin")).alias("zeppelin"), blank_if_undefined(F.col("hasstage")).alias("stage"),
        blank_if_undefined(F.col("dataattivazione")).alias("dataattivazione"),
        blank_if_undefined(F.col("datadisattivazione")).alias("datadisattivazione"),
    )


def lake_mb(tenants: DataFrame, table_sizes: DataFrame) -> DataFrame:
    sums = table_sizes.groupBy("tenantcode").agg(
        megabytes(F.sum(F.col("total_size").try_cast("bigint"))).alias("hive_dim_MB")
    )
    return _per_tenant(tenants, sums, {"hive_dim_MB": 0.0})


def csv_mb(tenants: DataFrame, datasets: DataFrame, sizes: DataFrame) -> DataFrame:
    sized = datasets.select("tenantcode", "datasetcode", "datasetversion").join(sizes, ["datasetcode", "datasetversion"])
    sums = sized.groupBy("tenantcode").agg(megabytes(F.sum("num_bytes")).alias("hdfs_csv_dim_MB"))
    return _per_tenant(tenants, sums, {"hdfs_csv_dim_MB": 0.0})


def binary_mb(tenants: DataFrame, datasets: DataFrame, sizes: DataFrame) -> DataFrame:
    """Attachments: the binary datasets a tenant refers to, each counted once, found by the number in their code."""
    used = datasets.select("tenantcode", "binaryiddataset", "binarydatasetversion").distinct()
    sized = join_on_code_suffix(used, "binaryiddataset", "binarydatasetversion", sizes, "datasetcode", "datasetversion")
    sums = sized.groupBy("tenantcode").agg(megabytes(F.sum("num_bytes")).alias("bin_dim_MB"))
    return _per_tenant(tenants, sums, {"bin_dim_MB": 0.0})


def serving_mb(
    tenants: DataFrame, datasets: DataFrame, serving: DataFrame, collections: DataFrame, records: DataFrame | None = None
) -> DataFrame:
    """Collection bytes shared out among the tenants by their records.

    The totals of a collection are summed from the per-tenant sums, ``records``: the ``collection_records`` of the datasets,
    which are used twice and best written down before.
    """
    records = collection_records(datasets, serving) if records is None else records
    mine = records.select("tenantcode", "solrcollectionname", F.col("numrecord").alias("_mine"))
    known = mine.join(tenants.select("tenantcode").distinct(), "tenantcode")
    total = known.groupBy("solrcollectionname").agg(F.sum("_mine").alias("_total"))
    full = known.join(total, "solrcollectionname", "left").join(collections, ["tenantcode", "solrcollectionname"], "left")
    share = F.try_divide(F.coalesce("_mine", F.lit(0)), F.col("_total"))
    size = F.when(F.col("_total").isNotNull(), F.coalesce("solr_byte", F.lit(0.0)) * share).otherwise(F.lit(0.0))
    sums = full.groupBy("tenantcode").agg(megabytes(F.sum(size)).alias("solrtenantcollmb"), F.lit(True).alias("_has"))
    out = tenants.select("tenantcode").distinct().join(sums, "tenantcode", "left")
    # a tenant without any dataset has size 0, one whose shares are all unknown has no size
    mb = F.when(F.col("_has").isNull(), F.lit(0.0)).otherwise(F.col("solrtenantcollmb"))
    return out.select(F.col("tenantcode").alias("tenant"), mb.alias("solrtenantcollmb"))


def stage_mb(tenants: DataFrame, stage: DataFrame) -> DataFrame:
    sums = stage.groupBy("tenantcode").agg(megabytes(F.sum(F.col("byte").try_cast("bigint"))).alias("hdfs_stage_dim"))
    return _per_tenant(tenants, sums, {"hdfs_stage_dim": 0.0})


def object_counts(tenants: DataFrame, streams: DataFrame) -> DataFrame:
    """Distinct smart objects and streams per tenant."""
    counts = streams.groupBy("tenantcode").agg(
        F.countDistinct("idvirtualentity").alias("num_smartobjects"), F.countDistinct("idstream").alias("num_streams")
    )
    full = _per_tenant(tenants, counts, {"num_smartobjects": 0, "num_streams": 0})
    return full.withColumn("tot_so_stream", F.col("num_smartobjects") + F.col("num_streams"))


def tenant_card(
    info: DataFrame, lake: DataFrame, csv: DataFrame, binary: DataFrame, serving: DataFrame, stage: DataFrame,
    objects: DataFrame,
) -> DataFrame:
    """Tenant information with every size and their total; the total is null when one of the sizes is."""
    sizes = join_all([lake, csv, binary, serving, stage, objects], "tenant")
    parts = [F.col(c) for c in ("hive_dim_MB", "hdfs_csv_dim_MB", "bin_dim_MB", "solrtenantcollmb", "hdfs_stage_dim")]
    total = sizes.withColumn("dimTotale", parts[0] + parts[1] + parts[2] + parts[3] + parts[4])
    return info.join(total, info["tenantcode"] == total["tenant"], "left")


def repeated_tenants(info: DataFrame) -> DataFrame:
    """Tenant codes described by more than one row; the tenant card expects none."""
    return info.groupBy("tenantcode").count().where(F.col("count") > 1)


def calls_monthly(calls: DataFrame) -> DataFrame:
    """Calls per tenant and month, with the rate over a 30-day month."""
    return calls.groupBy(
        F.col("tenant").alias("tenantcode"), F.col("year").alias("anno"), F.col("month").alias("mese")
    ).agg(
        F.sum("num_chiamate_mese").alias("num_chiamate_mese"),
        F.max("fruitori_distinti_tenant").alias("fruitori_distinti"),
        (F.sum("num_chiamate_mese") / SECONDS_PER_MONTH).alias("media_al_sec"),
        F.max("ultima_chiamata").alias("ultima_chiamata"),
    )


def calls_yearly(monthly: DataFrame, info: DataFrame) -> DataFrame:
    """Average calls per month with calls, for each known tenant and year."""
    yearly = monthly.groupBy("tenantcode", "anno").agg(
        (F.sum("num_chiamate_mese") / F.count("mese")).alias("media_chiamate_anno")
    )
    return yearly.join(info.select("tenantcode", "datadisattivazione"), "tenantcode")


def calls(monthly: DataFrame, info: DataFrame) -> DataFrame:
    return monthly.join(calls_yearly(monthly, info), ["tenantcode", "anno"])


def calls_of_year(all_calls: DataFrame, year: int) -> DataFrame:
    """Yearly average per tenant for one year."""
    return all_calls.where(F.col("anno") == year).select("tenantcode", F.col("media_chiamate_anno").alias("odata")).distinct()


def dataset_list(tenants: DataFrame, datasets: DataFrame) -> DataFrame:
    """Latest version of every dataset with its tenant; descriptions on one line."""
    owners = tenants.select("tenantcode", "organizationcode", "tenantname", "datadisattivazione")
    listed = latest_versions(datasets, "iddataset", "datasetversion").join(owners, "tenantcode")
    return listed.select(
        F.col("organizationcode").alias("organizzazione"), "tenantname", "tenantcode", "datadisattivazione",
        F.col("iddataset").alias("codice_dataset"), F.col("datasetstatus").alias("status"),
        F.col("datasetcode").alias("nome_dataset"), one_line(F.col("descrds")).alias("descr_dataset"),
        F.col("visibility").alias("visibilita"), F.col("datadomain").alias("dominio"),
        F.col("codsubdomain").alias("sottodominio"), F.col("elencotag").alias("tag"),
    )


def usage_register(card: DataFrame, listed: DataFrame, all_calls: DataFrame, register: DataFrame, year: int) -> DataFrame:
    """Tenant card with dataset count, yearly calls and the manually kept register."""
    counts = listed.groupBy("tenantcode").agg(F.count("codice_dataset").alias("dataset"))
    manual = register.drop("tenantname").withColumnRenamed("idecosystem", "_idecosystem")
    full = (
        card.join(counts, "tenantcode", "left")
        .join(calls_of_year(all_calls, year), "tenantcode", "left")
        .join(manual, "tenantcode", "left")
    )
    return full.select(
        F.col("_idecosystem").alias("idecosystem"), "ecosistema", "ente_pagante",
        F.col("organizationcode").alias("ente_titolare"), "incaricato_trattamento", "progetto", "tenantname",
        "tenantcode", "tenanttype", "referente", "email_referente", "dataultimoaggiornamento", "dataattivazione",
        "datadisattivazione", "in_consuntivo", "pagante", "dimTotale", "odata", "num_smartobjects", "num_streams",
        "tot_so_stream", "modulo_data_prep", "modulo_data_in_out", "dataset", "note",
    )


def records_by_tenant(
    tenants: DataFrame, datasets: DataFrame, sizes: DataFrame, serving: DataFrame, listed: DataFrame
) -> DataFrame:
    """Datasets, shared-domain datasets, records and last update per tenant.

    Datasets and serving store come first: they may lie in buckets of the same key.
    """
    facts = (
        datasets.select("tenantcode", "iddataset", "datasetcode", "datasetversion")
        .join(serving.select("iddataset", "datasetversion", "lasttimeid"), ["iddataset", "datasetversion"], "left")
        .join(sizes.select("datasetcode", "datasetversion", "num_rows"), ["datasetcode", "datasetversion"], "left")
    )
    per_dataset = facts.groupBy("tenantcode", "iddataset").agg(
        F.sum("num_rows").alias("_rows"), F.max("lasttimeid").alias("_last")
    )
    sums = per_dataset.groupBy("tenantcode").agg(
        F.count("iddataset").alias("dataset"), F.sum("_rows").alias("num_records_hdfs"),
        F.max("_last").alias("last_update_speedlayer"),
    )
    shared = listed.where(F.col("dominio") == SHARED_DOMAIN).groupBy("tenantcode").agg(
        F.count("codice_dataset").alias("dataset_multi")
    )
    named = tenants.select("tenantcode", "tenantname", "datadisattivazione").distinct()
    full = named.join(sums, "tenantcode", "left").join(shared, "tenantcode", "left")
    return full.fillna({"dataset": 0, "num_records_hdfs": 0}).select(
        "tenantcode", "tenantname", "datadisattivazione", "dataset", "dataset_multi", "num_records_hdfs",
        "last_update_speedlayer",
    )
