"""Registered queries (one per operator of SURVEY §2) and their DuckDB
oracle SQL.  Every query reads the given tables through the fixtures
and runs over all of their rows.

Column names and types agree between both sides: every computed column
is aliased, counts and sums are cast to BIGINT, and no column depends
on the wall clock.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.functions.paths import (
    config_level, normalize_location, path_identity, table_log_path, wildcard_path,
)
from commitlens.operators import merge, refine, registry, snapshots
from commitlens.operators.consolidate import consolidate_globs
from commitlens.plans import fixtures as fx
from commitlens.schemas import (
    ACTION_FIELDS, COMMIT_DATE, COMMIT_VERSION, COMMITTED_ON, EXTRA_CONFIG, FILE_NAME, IGNORE, INGEST_SEQ, PATH,
    PATH_ID, UPDATED_ON, WC_PATH, WC_PATH_ID,
)
from commitlens.session import scratch_path
from commitlens.sources.commit_log import with_commit_columns
from commitlens.sources.tables import RegistryStore, initialize
from commitlens.streaming.ingest import UnrefinedStore
from commitlens.streaming.interval_table import IntervalTable

QueryFn = Callable[[SparkSession, str], DataFrame]

FLAT_COLS = [PATH, PATH_ID, COMMIT_VERSION, COMMITTED_ON, COMMIT_DATE, FILE_NAME,
             "action", "operation", "add_path", "remove_path", "size"]
REFINED_COLS = [COMMIT_VERSION, COMMITTED_ON, FILE_NAME, PATH, PATH_ID, COMMIT_DATE,
                "operation", "readVersion", "isolationLevel", "isBlindAppend"]

CATALOG_DATABASES = "europe; asia , america"
CATALOG_PATTERN = "NATION_1*|*_2"
SLICE_LOWER, SLICE_UPPER = 1, 50


# ---- helpers ---------------------------------------------------------------

def _f1(spark, sf):
    return fx.stored_commit_actions(spark, sf)


def _refined(df: DataFrame) -> DataFrame:
    return df.select(*REFINED_COLS)


def _snapshot(df: DataFrame) -> DataFrame:
    return df.select(PATH_ID, "data_path", COMMIT_VERSION, COMMITTED_ON, COMMIT_DATE,
                     F.col("add_file.path").alias("add_path"),
                     F.col("add_file.size").alias("add_size"))


def _plain_config(spark, sf) -> DataFrame:
    """All F2 rows, ``**`` stripped (all ``ignore`` values)."""
    wild, plain = registry.split_wildcards(fx.master_entries(spark, sf))
    return plain.unionByName(wild)


def _registry(rows: DataFrame) -> DataFrame:
    return registry.registry_rows(rows.select(PATH, EXTRA_CONFIG))


def _ledger_changes(actions: DataFrame) -> DataFrame:
    """Ledger change rows: a table's mark advances at each commit."""
    c = actions.where(F.col("commitInfo").isNotNull())
    return c.select(F.col(PATH).alias("tableName"), F.col(COMMIT_VERSION).alias("latestVersion"),
                    F.col(COMMITTED_ON).alias(UPDATED_ON), F.col(COMMIT_VERSION).alias(merge.SEQ))


# ---- F1 --------------------------------------------------------------------

def q_flatten_commit_info(spark, sf):
    return _refined(refine.flatten_commit_info(_f1(spark, sf)))


def q_commit_enrich(spark, sf):
    f1 = _f1(spark, sf)
    src = f1.select(*ACTION_FIELDS, F.col(FILE_NAME).alias("_file"), F.col(COMMITTED_ON).alias("_mtime"))
    e = with_commit_columns(src, file_col=F.col("_file"), mtime_col=F.col("_mtime"))
    return e.select(FILE_NAME, PATH, PATH_ID, COMMIT_VERSION, COMMITTED_ON, COMMIT_DATE)


def q_table_log_path(spark, sf):
    f1 = _f1(spark, sf)
    return f1.select(table_log_path(PATH).alias("log_path"), PATH_ID).distinct()


def q_batch_partitions(spark, sf):
    return merge.batch_partitions(fx.split_batch(_f1(spark, sf)))


def q_live_files(spark, sf):
    return _snapshot(snapshots.live_files(_f1(spark, sf)))


def q_live_files_incremental(spark, sf):
    f1 = _f1(spark, sf)
    # J8 carries the previous snapshot's last-version rows: take them as
    # the state (no expansion of the history), written once to the
    # shared folder as a production job would keep it between runs
    # and so is the landed batch, which the operator reads several times
    state = snapshots.snapshot_state(fx.split_target(f1)).checkpoint(eager=True)
    new = merge.insert_only_merge(fx.split_batch(f1), fx.split_target(f1)).checkpoint(eager=True)
    return _snapshot(snapshots.live_files_incremental(state, new, previous_is_state=True))


def q_live_files_continued(spark, sf):
    """J8 from a whole previous snapshot: A5 finds its last versions."""
    f1 = _f1(spark, sf)
    new = merge.insert_only_merge(fx.split_batch(f1), fx.split_target(f1)).checkpoint(eager=True)
    return _snapshot(snapshots.live_files_incremental(snapshots.live_files(fx.split_target(f1)).checkpoint(eager=True), new))


def q_live_files_state(spark, sf):
    """The snapshot's rows at each table's last version, without expansion."""
    return _snapshot(snapshots.snapshot_state(_f1(spark, sf)))


def q_live_file_metrics(spark, sf):
    return snapshots.live_file_metrics(_f1(spark, sf))


def q_replay_file_intervals(spark, sf):
    """Q19 replay mode: per file, the versions where its latest action is an add."""
    iv = snapshots.replay_intervals(_f1(spark, sf))
    return iv.select(PATH_ID, "data_path", "file", "start", "end",
                     F.col("add_file.size").alias("add_size"))


INCREMENT_DAYS = (10, 20)  # last day (ingest_seq) of the first and of the second increment


def q_live_file_intervals(spark, sf):
    """W3 sink: three stored increments; each reads only the open side of
    the one before."""
    f1 = _f1(spark, sf)
    stored = IntervalTable(spark, scratch_path(spark, "intervals"))
    day, (a, b) = F.col(INGEST_SEQ), INCREMENT_DAYS
    for n, part in enumerate((day <= a, (day > a) & (day <= b), day > b)):
        stored.apply(n, f1.where(part))
    return stored.intervals(2).select(PATH_ID, "data_path", "file", "start", "end", F.col("add_file.size").alias("add_size"))


def q_dedup_adds(spark, sf):
    adds, _ = snapshots.file_actions(_f1(spark, sf))
    return snapshots.dedup_adds(adds).select(
        PATH_ID, "data_path", COMMIT_VERSION, F.col("add_file.path").alias("add_path"),
        F.col("add_file.size").alias("add_size"))


# ---- F1 + F3 -----------------------------------------------------------------

def q_insert_only_merge(spark, sf):
    f1 = _f1(spark, sf)
    new = merge.insert_only_merge(fx.split_batch(f1), fx.split_target(f1))
    return fx.flat_actions(new).select(*FLAT_COLS)


def q_land_batches(spark, sf):
    """S9 + J1 + F8 on storage: two overlapping batches land in a catalog
    table; every action once."""
    f1 = _f1(spark, sf).drop(INGEST_SEQ)
    store = UnrefinedStore(spark, scratch_path(spark, "landed"), table=f"landed_{uuid.uuid4().hex[:12]}")
    for n, part in enumerate((fx.split_target(f1), fx.split_batch(f1))):
        store.land(part, "f1", "once", n)
    return fx.flat_actions(store.read().withColumn(INGEST_SEQ, F.lit(0).cast("bigint"))).select(*FLAT_COLS)


def q_refine_commits(spark, sf):
    f1 = _f1(spark, sf)
    first = refine.refine_batch(fx.split_target(f1), None)          # first run: overwrite
    added = refine.refine_batch(fx.split_batch(f1), first)          # later run: merge
    return _refined(first).unionByName(_refined(added))


def q_changes_since(spark, sf):
    f1 = _f1(spark, sf)
    hwm = refine.latest_version(fx.split_target(f1)).first()["latest_version"]
    return fx.flat_actions(refine.changes_since(f1, hwm)).select(*FLAT_COLS)


def q_incremental_refine(spark, sf):
    f1 = _f1(spark, sf)
    target = fx.split_target(f1)
    refined_so_far = refine.refine_batch(target, None)
    hwm = refine.latest_version(target).first()["latest_version"]
    new_rows, _ = refine.incremental_refine(f1, refined_so_far, hwm)
    return _refined(new_rows)


def q_latest_version(spark, sf):
    return refine.latest_version(_f1(spark, sf))


def q_high_water_mark(spark, sf):
    """A4: the marks of all tables' commits; a second name per table has
    no mark and starts at 0."""
    f1 = _f1(spark, sf)
    names = f1.select(F.explode(F.array(F.col(PATH), F.concat(F.col(PATH), F.lit("_new")))).alias("tableName"))
    return merge.high_water_marks(_ledger_changes(f1), names)


def q_ledger_upsert(spark, sf):
    return merge.ledger_current(_ledger_changes(_f1(spark, sf)))


# ---- F2 ----------------------------------------------------------------------

def q_config_scan(spark, sf):
    rows = registry.config_scan(fx.master_entries(spark, sf))
    return rows.select(PATH, IGNORE, config_level(EXTRA_CONFIG).alias("wildCardLevel"))


def q_expand_wildcards(spark, sf):
    wild, plain = registry.split_wildcards(registry.config_scan(fx.master_entries(spark, sf)))
    return (wild.withColumn("expand", F.lit(True)).unionByName(plain.withColumn("expand", F.lit(False)))
            .select(PATH, IGNORE, config_level(EXTRA_CONFIG).alias("wildCardLevel"), "expand"))


def q_path_identity(spark, sf):
    m = fx.master_entries(spark, sf).select(PATH).distinct()
    n = normalize_location(PATH)
    return m.select(PATH, n.alias("normalizedLocation"), path_identity(n).alias(PATH_ID))


def q_wildcard_path(spark, sf):
    rows = _plain_config(spark, sf)
    lv = config_level(EXTRA_CONFIG)
    return rows.select(PATH, lv.alias("wildCardLevel"), wildcard_path(F.col(PATH), lv).alias(WC_PATH))


def q_registry_rows(spark, sf):
    r = _registry(_plain_config(spark, sf))
    return r.select(PATH, PATH_ID, WC_PATH, WC_PATH_ID,
                    config_level(EXTRA_CONFIG).alias("wildCardLevel"),
                    "fullTableName", COMMIT_VERSION, IGNORE)


def q_consolidate_globs(spark, sf):
    return consolidate_globs(_registry(_plain_config(spark, sf)))


def q_stream_slice(spark, sf):
    return registry.stream_slice(_registry(_plain_config(spark, sf)), SLICE_LOWER, SLICE_UPPER)


def q_registry_upsert(spark, sf):
    plain = _plain_config(spark, sf)
    n = plain.count()
    t = _registry(fx.registry_split(plain, "target", n)).withColumn(
        UPDATED_ON, F.lit(fx.REGISTRY_TARGET_UPDATED))
    b = _registry(fx.registry_split(plain, "batch", n)).withColumn(
        UPDATED_ON, F.lit(fx.REGISTRY_BATCH_UPDATED))
    return merge.registry_upsert(t, b).select(
        PATH, PATH_ID, WC_PATH, WC_PATH_ID, config_level(EXTRA_CONFIG).alias("wildCardLevel"),
        UPDATED_ON)


def q_registry_scan(spark, sf):
    """Two refreshes of a stored registry, read back."""
    plain = _plain_config(spark, sf)
    n = plain.count()
    store = RegistryStore(spark, scratch_path(spark, "registry"))
    for side, at in (("target", fx.REGISTRY_TARGET_UPDATED), ("batch", fx.REGISTRY_BATCH_UPDATED)):
        store.upsert(_registry(fx.registry_split(plain, side, n)).withColumn(UPDATED_ON, F.lit(at)))
    return store.current().select(
        PATH, PATH_ID, WC_PATH, WC_PATH_ID, config_level(EXTRA_CONFIG).alias("wildCardLevel"), UPDATED_ON)


def q_bootstrap_tables(spark, sf):
    """The metric tables are made through the catalog, filled at their
    locations and counted through the catalog."""
    db = f"boot_{uuid.uuid4().hex[:12]}"
    defs = initialize(spark, scratch_path(spark, "boot"), db)
    fx.master_entries(spark, sf).select(PATH, IGNORE, EXTRA_CONFIG).write.mode("append").parquet(defs["master"].path)
    RegistryStore(spark, defs["registry"].path).upsert(_registry(_plain_config(spark, sf)))
    for d in defs.values():
        spark.catalog.refreshTable(d.name)
    keys = {"delta_location_details": [PATH_ID, WC_PATH_ID], "master": [PATH], "processed_log": ["tableName"],
            "unrefined_metrics": [PATH_ID]}
    counts = [spark.table(f"{db}.{t}").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct(*k).alias("n_keys"))
              .select(F.lit(t).alias("name"), "n_rows", "n_keys") for t, k in keys.items()]
    return reduce(DataFrame.unionByName, counts)


# ---- F4 ----------------------------------------------------------------------

def q_catalog_filter(spark, sf):
    return registry.catalog_filter(fx.catalog_inventory(spark, sf),
                                   CATALOG_DATABASES, CATALOG_PATTERN)


def q_resolve_locations(spark, sf):
    inv = fx.catalog_inventory(spark, sf)
    return registry.resolve_locations(fx.resolution_entries(inv), inv, databases=fx.resolution_databases(inv))


QUERIES: dict[str, QueryFn] = {
    "flatten_commit_info": q_flatten_commit_info,
    "commit_enrich": q_commit_enrich,
    "table_log_path": q_table_log_path,
    "batch_partitions": q_batch_partitions,
    "live_files": q_live_files,
    "live_files_incremental": q_live_files_incremental,
    "live_file_metrics": q_live_file_metrics,
    "live_files_continued": q_live_files_continued,
    "live_files_state": q_live_files_state,
    "live_file_intervals": q_live_file_intervals,
    "dedup_adds": q_dedup_adds,
    "replay_file_intervals": q_replay_file_intervals,
    "insert_only_merge": q_insert_only_merge,
    "land_batches": q_land_batches,
    "refine_commits": q_refine_commits,
    "changes_since": q_changes_since,
    "incremental_refine": q_incremental_refine,
    "latest_version": q_latest_version,
    "high_water_mark": q_high_water_mark,
    "ledger_upsert": q_ledger_upsert,
    "config_scan": q_config_scan,
    "expand_wildcards": q_expand_wildcards,
    "path_identity": q_path_identity,
    "wildcard_path": q_wildcard_path,
    "registry_rows": q_registry_rows,
    "consolidate_globs": q_consolidate_globs,
    "stream_slice": q_stream_slice,
    "registry_upsert": q_registry_upsert,
    "registry_scan": q_registry_scan,
    "bootstrap_tables": q_bootstrap_tables,
    "catalog_filter": q_catalog_filter,
    "resolve_locations": q_resolve_locations,
}
