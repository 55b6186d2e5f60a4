"""The five governance reports, as the frames their files are written from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import decimal_comma

# Columns of the manual register, refreshed from the register itself when the report is written.
MANUAL = [
    "idecosystem", "ecosistema", "ente_pagante", "incaricato_trattamento", "progetto", "in_consuntivo", "pagante",
    "modulo_data_prep", "modulo_data_in_out", "note",
]


def report_register(usage: DataFrame, register: DataFrame) -> DataFrame:
    computed = usage.drop(*MANUAL)
    full = computed.join(register.select("tenantcode", *MANUAL), "tenantcode", "left")
    return full.select(
        "idecosystem", "ecosistema", "ente_pagante", "ente_titolare", "incaricato_trattamento", "progetto",
        "tenantname", "tenantcode", "tenanttype", "referente", "email_referente", "dataultimoaggiornamento",
        "dataattivazione", "datadisattivazione", "in_consuntivo", "pagante",
        decimal_comma(F.col("dimTotale")).alias("dimTotale"), decimal_comma(F.col("odata")).alias("odata"),
        "num_smartobjects", "num_streams", "tot_so_stream", "modulo_data_prep", "modulo_data_in_out", "dataset", "note",
    ).orderBy("tenantcode")


def report_sizes(card: DataFrame) -> DataFrame:
    def comma(name: str):
        return decimal_comma(F.col(name)).alias(name)

    return card.select(
        "tenantcode", comma("hive_dim_MB"), comma("hdfs_csv_dim_MB"), comma("bin_dim_MB"), comma("solrtenantcollmb"),
        comma("hdfs_stage_dim"), "num_smartobjects", "num_streams", "tot_so_stream", comma("dimTotale"),
    ).orderBy("tenantcode")


def report_calls(all_calls: DataFrame, usage: DataFrame) -> DataFrame:
    """Calls of named tenants, the busiest months first; months with equal calls, often most of them, by tenant and time, so
    that the order can be cut into ranges anywhere."""
    named = usage.select("tenantcode", "idecosystem", "tenantname", "in_consuntivo", "pagante")
    full = all_calls.drop("datadisattivazione").join(named, "tenantcode").where(F.col("tenantname") != "")
    return full.orderBy(F.desc("media_al_sec"), "tenantcode", "anno", "mese").select(
        "idecosystem", "tenantname", "anno", "mese", "num_chiamate_mese",
        decimal_comma(F.col("media_al_sec")).alias("media_al_sec"), "fruitori_distinti", "ultima_chiamata",
        "in_consuntivo", "pagante",
    )


def report_datasets(listed: DataFrame) -> DataFrame:
    return listed.orderBy("organizzazione", "tenantname", "codice_dataset")


def report_records(records: DataFrame) -> DataFrame:
    return records.drop("tenantcode").orderBy("tenantname")
