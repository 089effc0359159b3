"""The entry points as functions over stores.

E1  refresh the registry from the config table or from the catalog;
E2  stream every registered glob of a slice into the unrefined table;
E3  refine new unrefined rows into per-commit metrics;
and the snapshot stage: keep live-file intervals of all landed tables.
"""

from __future__ import annotations

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.operators.consolidate import consolidate_globs
from commitlens.operators.registry import (
    catalog_filter, config_scan, databases_from_catalog, expand_wildcards, inventory_from_catalog, parse_databases,
    registry_rows, resolve_locations, stream_slice,
)
from commitlens.schemas import (
    EXTRA_CONFIG, FULL_TABLE_NAME, PATH, WILDCARD_LEVEL,
)
from commitlens.sources.discovery import table_paths
from commitlens.sources.tables import RegistryStore
from commitlens.streaming.ingest import Marks, await_all, start_ingest_streams
from commitlens.streaming.progress import ProgressCollector
from commitlens.streaming.refine_job import run_incremental_refine
from commitlens.streaming.interval_table import IntervalTable
from commitlens.streaming.refine_stream import start_refine_stream, start_snapshot_stream

CATALOG_LEVEL = "1"   # tables taken from the catalog are watched at level 1


def resolve_config(spark: SparkSession, rows: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """S6 for config rows: databases and names through the inventory (by
    default that of the session catalog), paths by the presence of a
    commit log on storage."""
    inv = inventory if inventory is not None else inventory_from_catalog(spark)
    entries = rows.select(F.col(PATH).alias("entry"), EXTRA_CONFIG)
    found = resolve_locations(entries, inv, table_paths=table_paths(rows),
                              current_db=spark.catalog.currentDatabase(), databases=databases_from_catalog(spark))
    return found.select(FULL_TABLE_NAME, PATH, EXTRA_CONFIG)


def refresh_registry_from_config(spark: SparkSession, master: DataFrame, registry: RegistryStore,
                                 inventory: DataFrame | None = None, truncate: bool = False,
                                 strict_discovery: bool = False) -> int:
    """Config scan -> ``**`` expansion -> resolution -> registry rows
    -> upsert.  Returns the registry sequence written."""
    rows = expand_wildcards(config_scan(master), strict=strict_discovery)
    return registry.upsert(registry_rows(resolve_config(spark, rows, inventory)), truncate)


def refresh_registry_from_catalog(spark: SparkSession, registry: RegistryStore,
                                  databases: str | None = None, pattern: str | None = None,
                                  inventory: DataFrame | None = None, truncate: bool = False) -> int:
    """E1 from the catalog: matching tables of the listed databases,
    watched at level 1."""
    inv = inventory if inventory is not None else inventory_from_catalog(
        spark, parse_databases(databases) or None)
    tables = catalog_filter(inv, databases, pattern).withColumn(
        EXTRA_CONFIG, F.create_map(F.lit(WILDCARD_LEVEL), F.lit(CATALOG_LEVEL)))
    return registry.upsert(registry_rows(tables), truncate)


def run_ingest(spark: SparkSession, registry: RegistryStore, target_root: str, checkpoint_base: str,
               lower: int = 1, upper: int = 50, consolidate: bool = True,
               consolidate_first: bool = False, use_wildcard_path: bool = True,
               strict_consolidation: bool = False, collector: ProgressCollector | None = None,
               **stream_kwargs) -> list:
    """Slice the registry, optionally consolidate, start one stream
    per glob (listener registered first), wait for all of them.

    The reference consolidates the slice (``consolidate_first=False``);
    consolidating first makes slices partition the consolidated set.
    """
    cur = registry.current()
    if consolidate and consolidate_first and use_wildcard_path:
        from commitlens.schemas import WC_PATH, WC_PATH_ID
        kept = consolidate_globs(cur, strict=strict_consolidation).select(WC_PATH, WC_PATH_ID)
        cur = cur.join(kept, [WC_PATH, WC_PATH_ID], "left_semi")
    paths = stream_slice(cur, lower, upper, use_wildcard_path)
    if consolidate and not consolidate_first:
        paths = consolidate_globs(paths, "path", "path_id", strict=strict_consolidation)
    if collector is not None:
        spark.streams.addListener(collector)     # before any stream starts (Q12)
    try:
        queries = start_ingest_streams(spark, paths, target_root, checkpoint_base, **stream_kwargs)
        await_all(queries)
    finally:
        if collector is not None:
            # listener events arrive asynchronously: let the last ones land
            ids = {str(q.id) for q in locals().get("queries", [])}
            deadline = time.time() + 30
            while time.time() < deadline and not ids <= {
                    r[2] for r in collector.rows() if r[0] == "terminated"}:
                time.sleep(0.2)
            spark.streams.removeListener(collector)
            if not ids <= {r[2] for r in collector.rows() if r[0] == "terminated"} and sys.exc_info()[0] is None:
                raise RuntimeError("termination events did not arrive; the progress rows may be incomplete")
    return queries


def run_refine_stream(spark: SparkSession, unrefined_root: str, refined_path: str, checkpoint: str) -> None:
    """E3 as a stream: every batch that was landed since the checkpoint is
    refined; no ledger is kept."""
    await_all([start_refine_stream(spark, unrefined_root, refined_path, checkpoint)])


def run_snapshots(spark: SparkSession, unrefined_root: str, interval_root: str, checkpoint: str) -> IntervalTable:
    """The snapshot stage: every batch landed since the checkpoint goes into
    the stored live-file intervals."""
    await_all([start_snapshot_stream(spark, unrefined_root, interval_root, checkpoint)])
    return IntervalTable(spark, interval_root)


def run_refine(spark: SparkSession, unrefined_root: str, refined_path: str, ledger_path: str) -> Marks:
    """One increment of refinement; returns the new high-water marks."""
    return run_incremental_refine(spark, unrefined_root, refined_path, ledger_path)
