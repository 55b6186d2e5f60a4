"""The job over the governance and metadata marts: every mart is written once a load, and the reports from the written marts.

Marts are listed in the order of what they need. A mart is a bucketed ORC table of its load, so marts that share a key are
joined without a shuffle; its plain name is a view, which a load moves on when all its marts are complete. A load that breaks
off is repeated under the same load time and goes on behind the marts it has finished.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.files import Files
from tidemark.plans import catalog, governance, metadata, reports, space
from tidemark.session import bucketed, own_shuffles_only
from tidemark.sinks.csv_out import write_report
from tidemark.sinks.tables import with_load_time
from tidemark.sources.listing import parse_collection_listing, parse_stage_listing

Frames = Callable[[str], DataFrame]  # a source or a mart by its name

RECORDS = "tenant_collection_records"  # the sums of dataset versions and serving store that several marts need


@dataclass(frozen=True)
class Mart:
    name: str
    build: Callable[[Frames], DataFrame]
    needs: tuple[str, ...] = ()  # marts it is built from
    keys: tuple[str, ...] = ()  # what its rows are bucketed and sorted by
    history: bool = False
    unique: bool = False  # whether ``keys`` must not repeat


class RepeatedKeys(ValueError):
    """A mart describes the same key twice."""


def governance_marts(year: int, own_databases: Iterable[str], serving_root: str) -> list[Mart]:
    """What tenants store, call and own.

    Sources: tenants, datasets, streams, serving_dim, dataset_sizes, catalog, owners, space_lines, stage_lines, calls, register.
    """
    own = list(own_databases)
    version = ("iddataset", "datasetversion")
    return [
        Mart("dataset_versions", lambda f: f("datasets"), keys=version),
        Mart("serving_versions", lambda f: f("serving_dim"), keys=version),
        Mart(RECORDS, lambda f: governance.collection_records(f("dataset_versions"), f("serving_versions")),
             ("dataset_versions", "serving_versions"), ("tenantcode",)),
        Mart("info_tenant", lambda f: governance.tenant_info(f("tenants"), f("dataset_versions"), f("serving_versions"), f(RECORDS)),
             (RECORDS,), ("tenantcode",), unique=True),
        Mart("solr_tot_bytes", lambda f: space.collection_bytes(f("datasets"), parse_collection_listing(f("space_lines"), serving_root)),
             keys=("tenantcode",), history=True),
        Mart("area_stage_bytes", lambda f: parse_stage_listing(f("stage_lines")), history=True),
        Mart("info_dim_hive_table_tenant", lambda f: catalog.table_sizes(f("catalog"), f("dataset_versions"), f("owners"), own), ("dataset_versions",)),
        Mart("info_tenant_completo", _card,
             ("info_tenant", "info_dim_hive_table_tenant", "solr_tot_bytes", "area_stage_bytes", "dataset_versions", "serving_versions", RECORDS),
             ("tenantcode",)),
        Mart("info_chiamate_mese", lambda f: governance.calls(governance.calls_monthly(f("calls")), f("info_tenant")), ("info_tenant",), ("tenantcode",)),
        Mart("info_elenco_dataset", lambda f: governance.dataset_list(f("tenants"), f("dataset_versions")), ("dataset_versions",)),
        Mart("info_registro_fruizione",
             lambda f: governance.usage_register(f("info_tenant_completo"), f("info_elenco_dataset"), f("info_chiamate_mese"), f("register"), year),
             ("info_tenant_completo", "info_elenco_dataset", "info_chiamate_mese"), ("tenantcode",)),
        Mart("info_dim_dataset_tenant",
             lambda f: governance.records_by_tenant(f("tenants"), f("dataset_versions"), f("dataset_sizes"), f("serving_versions"), f("info_elenco_dataset")),
             ("dataset_versions", "serving_versions", "info_elenco_dataset"), ("tenantcode",)),
    ]


def metadata_marts(tables: Iterable[str]) -> list[Mart]:
    """The catalogue's snapshots, each with a history; the sources are the catalogue's tables."""
    names = list(tables)

    def mart(name: str, build: Callable[[metadata.Tables], DataFrame], history: bool = True) -> Mart:
        return Mart(name, lambda f: build({n: f(n) for n in names}), history=history)

    return [
        mart("meta_tenant", metadata.mart_tenant), mart("meta_stream", metadata.mart_stream), mart("meta_dataset", metadata.mart_dataset),
        mart("meta_dataset_extended", metadata.mart_dataset_extended), mart("meta_api", metadata.mart_api),
    ]


def _card(f: Frames) -> DataFrame:
    tenants, datasets, sizes = f("tenants"), f("dataset_versions"), f("dataset_sizes")
    return governance.tenant_card(
        f("info_tenant"), governance.lake_mb(tenants, f("info_dim_hive_table_tenant")), governance.csv_mb(tenants, datasets, sizes),
        governance.binary_mb(tenants, datasets, sizes),
        governance.serving_mb(tenants, datasets, f("serving_versions"), f("solr_tot_bytes"), f(RECORDS)),
        governance.stage_mb(tenants, f("area_stage_bytes")), governance.object_counts(tenants, f("streams")),
    )


def needed(marts: list[Mart], wanted: Iterable[str] | None) -> list[Mart]:
    """The wanted marts and all they are built from, in the order of the list."""
    if wanted is None:
        return marts
    known, found, waiting = {m.name: m for m in marts}, set(), list(wanted)
    while waiting:
        name = waiting.pop()
        if name not in found:
            found.add(name)
            waiting += known[name].needs
    return [m for m in marts if m.name in found]


def planned(marts: list[Mart], sources: Frames, written: Iterable[str] = ()) -> Frames:
    """Marts as frames that are not written: one plan for a single mart or report, in which Spark reuses equal shuffles.

    Marts in ``written`` are written down when they are first used, in buckets of their keys: small ones that others use many
    times, taking other columns each time, so that their plans have no equal shuffles.
    """
    known, built, kept = {m.name: m for m in marts}, {}, set(written)

    def frame(name: str) -> DataFrame:
        if name not in known:
            return sources(name)
        if name not in built:
            rows = known[name].build(frame)
            built[name] = bucketed(rows, name, *known[name].keys) if name in kept else rows
        return built[name]

    return frame


def load_marts(
    spark: SparkSession, marts: list[Mart], sources: Frames, root: str, load_time: str, prefix: str = "",
    wanted: Iterable[str] | None = None, buckets: int | None = None,
) -> Frames:
    """Write the marts of one load; returns them, and the sources, by name.

    ``prefix`` begins the names of tables and views (``database.`` or more). A mart's rows lie below ``root/<mart>/<load>``,
    its history in ``root/<mart>_storico``, one folder a load, which a repeated load replaces. The views move on when all marts
    are complete; tables of the load before stay for their readers, older ones are dropped. A mart without rows is an empty
    table. ``buckets`` follows the session's shuffle partitions; nothing depends on it but the number of files.
    """
    files, load, root = Files(spark), re.sub(r"[^0-9]", "", load_time), root.rstrip("/")
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    done: dict[str, DataFrame] = {}

    def frame(name: str) -> DataFrame:
        return done[name] if name in done else sources(name)

    chosen = needed(marts, wanted)
    for mart in chosen:
        table, path = f"{prefix}{mart.name}__{load}", f"{root}/{mart.name}/{load}"
        if not files.is_complete(path):
            _write(mart, mart.build(frame), table, path, count)
        elif not spark.catalog.tableExists(table):
            _register(spark, table, path)
        rows = spark.table(table)
        if mart.unique and rows.groupBy(*mart.keys).count().where("count > 1").limit(1).count():
            raise RepeatedKeys(f"{mart.name}: {', '.join(mart.keys)} repeat")
        if mart.history:
            kept = f"{root}/{mart.name}_storico/load={load}"
            if not files.is_complete(kept):
                with_load_time(rows, load_time).write.mode("overwrite").orc(kept)
        done[mart.name] = rows
    for mart in chosen:
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{mart.name} AS SELECT * FROM {prefix}{mart.name}__{load}")
        for old in files.names(f"{root}/{mart.name}")[:-2]:
            if old != load:
                spark.sql(f"DROP TABLE IF EXISTS {prefix}{mart.name}__{old}")
                files.delete(f"{root}/{mart.name}/{old}")
    return frame


def _write(mart: Mart, rows: DataFrame, table: str, path: str, buckets: int) -> None:
    spark = rows.sparkSession
    if mart.keys:  # one task a bucket, hence one file
        writer = rows.repartition(buckets, *mart.keys).write.bucketBy(buckets, *mart.keys).sortBy(*mart.keys)
    else:  # as the mart's last join or group has dealt its rows out; a shuffle more would only even out its files
        writer = rows.write
    with own_shuffles_only(spark):
        writer.mode("overwrite").format("orc").option("path", path).saveAsTable(table)
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def _register(spark: SparkSession, table: str, path: str) -> None:
    """A complete mart that broke off before its table was entered, or whose metastore is gone: entered without its buckets,
    whose number the files alone don't tell; joins then shuffle it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.orc(path).schema)
    spark.sql(f"CREATE TABLE {table} ({columns}) USING orc LOCATION '{path}'")
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def history(spark: SparkSession, root: str, mart: str) -> DataFrame:
    """All loads of a mart, each row with its load time."""
    return spark.read.orc(f"{root.rstrip('/')}/{mart}_storico").drop("load")


REPORTS: dict[str, Callable[[Frames], DataFrame]] = {
    "registro_di_fruizione": lambda f: reports.report_register(f("info_registro_fruizione"), f("register")),
    "dimensioni_tenant": lambda f: reports.report_sizes(f("info_tenant_completo")),
    "report_chiamate": lambda f: reports.report_calls(f("info_chiamate_mese"), f("info_registro_fruizione")),
    "report_elenco_dataset": lambda f: reports.report_datasets(f("info_elenco_dataset")),
    "report_dim_dataset_tenant": lambda f: reports.report_records(f("info_dim_dataset_tenant")),
}


def export_reports(frames: Frames, folder: str, moment: str, wanted: Iterable[str] | None = None) -> dict[str, str]:
    """Write the reports, or those wanted, from marts and sources as ``<folder>/<report>_<yyyymmdd_hhmmss>``; returns their paths.

    ``moment`` is the time in the names, as ``2024-01-02 03:04:05``.
    """
    digits = re.sub(r"[^0-9]", "", moment)
    stamp = f"{digits[:8]}_{digits[8:14].ljust(6, '0')}"
    written = {}
    for name in REPORTS if wanted is None else wanted:
        written[name] = f"{folder.rstrip('/')}/{name}_{stamp}"
        write_report(REPORTS[name](frames), written[name], single_file=True)
    return written
