"""End to end: bootstrap, E1 registry refresh, E2 streams, E3 refine."""


from pyspark.sql import functions as F

from commitlens.plans.jobs import (
    refresh_registry_from_catalog, refresh_registry_from_config, run_ingest, run_refine,
)
from commitlens.schemas import CATALOG_INVENTORY_SCHEMA, MASTER_SCHEMA
from commitlens.session import local_path
from commitlens.sources.tables import (
    DatabaseDefinition, RegistryStore, TableDefinition, initialize,
)
from commitlens.streaming.ingest import UnrefinedStore
from commitlens.streaming.progress import ProgressCollector
from commitlens.streaming.refine_job import read_refined

from test_streams import f5_actions, write_f5


def test_definitions_validate():
    import pytest
    with pytest.raises(ValueError):
        TableDefinition("", "/p", MASTER_SCHEMA)
    with pytest.raises(ValueError):
        TableDefinition("db.t", " ", MASTER_SCHEMA)
    with pytest.raises(ValueError):
        DatabaseDefinition("")


def test_bootstrap(spark, work):
    defs = initialize(spark, local_path(work), "cl_boot")
    assert spark.catalog.databaseExists("cl_boot")
    for d in defs.values():
        assert spark.catalog.tableExists(d.name)
    assert initialize(spark, local_path(work), "cl_boot") == defs   # idempotent
    assert spark.table(defs["registry"].name).count() == 0


def test_registry_store_truncate(spark, work):
    from commitlens.operators.registry import registry_rows

    reg = RegistryStore(spark, work + "/registry")
    rows = spark.createDataFrame([("/a/t1", False, {"wildCardLevel": "0"}),
                                  ("/a/t2", False, {"wildCardLevel": "0"})], MASTER_SCHEMA)
    reg.upsert(registry_rows(rows.select("deltaLocation", "extraConfig")))
    reg.upsert(registry_rows(rows.limit(1).select("deltaLocation", "extraConfig")))
    assert reg.current().count() == 2
    reg.upsert(registry_rows(rows.limit(1).select("deltaLocation", "extraConfig")), truncate=True)
    assert [r.deltaLocation for r in reg.current().collect()] == ["/a/t1"]


def test_registry_store_is_written_anew_now_and_then(spark, work):
    """Refreshes do not pile up, and the merged view is that of all of them."""
    from commitlens.operators.merge import registry_upsert
    from commitlens.operators.registry import registry_rows

    def refresh(n):
        rows = [(f"/a/t{k}", False, {"wildCardLevel": "0" if n < 4 else "1"}) for k in range(n % 3, n + 3)]
        df = registry_rows(spark.createDataFrame(rows, MASTER_SCHEMA).select("deltaLocation", "extraConfig"))
        return df.withColumn("updatedOn", F.lit(f"2024-01-{n + 1:02d}").cast("timestamp"))

    reg = RegistryStore(spark, work + "/registry", compact_every=4)
    want, read = None, []
    for n in range(10):
        reg.upsert(refresh(n))
        want = refresh(n) if want is None else registry_upsert(want, refresh(n))
        read.append(reg.visible().select("_seq").distinct().count())
    key = ["deltaLocation", "wcPath", "updatedOn", F.to_json("extraConfig").alias("x")]
    assert sorted(map(str, reg.current().select(*key).collect())) == sorted(map(str, want.select(*key).collect()))
    assert max(read) <= 4 and read[-1] < 4


def test_end_to_end(spark, work):
    write_f5(spark, work)
    base = local_path(work)
    master = spark.createDataFrame([
        (f"{base}/lake/**", False, {"wildCardLevel": "-1"}),       # expanded by listing
        (f"{base}/lake/db0/t0", False, {"wildCardLevel": "0"}),    # a path (glob over db0/*)
        (f"{base}/lake/skipped", True, {"wildCardLevel": "0"}),    # ignored
    ], MASTER_SCHEMA)
    reg = RegistryStore(spark, work + "/registry")
    refresh_registry_from_config(spark, master, reg)
    cur = reg.current()
    assert cur.count() == 4
    # Consolidation drops the per-table globs covered by db0/* (substring rule)
    c = ProgressCollector()
    qs = run_ingest(spark, reg, work + "/unrefined", work + "/ck", collector=c, max_files_per_trigger=9)
    assert 1 <= len(qs) <= 4
    store = UnrefinedStore(spark, work + "/unrefined")
    want = f5_actions(spark).count()
    assert store.read().count() == want
    # E3
    refined, ledger = work + "/refined", work + "/processed"
    run_refine(spark, work + "/unrefined", refined, ledger)
    n = f5_actions(spark).where(F.col("commitInfo").isNotNull()).count()
    assert read_refined(spark, refined).count() == n
    # everything again: no new rows anywhere
    refresh_registry_from_config(spark, master, reg)
    assert reg.current().count() == 4
    run_ingest(spark, reg, work + "/unrefined", work + "/ck")
    run_refine(spark, work + "/unrefined", refined, ledger)
    assert store.read().count() == want and read_refined(spark, refined).count() == n


def test_refine_and_snapshot_stages_follow_the_landing(spark, work):
    """Ingest in two runs, each followed by the two stages."""
    import datetime as dt

    from commitlens.operators.snapshots import replay_intervals
    from commitlens.plans.jobs import run_refine_stream, run_snapshots
    from commitlens.streaming.ingest import await_all, start_ingest_stream
    from test_streams import ALL

    for until in (dt.datetime(2024, 1, 17), None):
        write_f5(spark, work, until=until)
        await_all([start_ingest_stream(spark, work + ALL, "all", work + "/unrefined", work, max_files_per_trigger=13)])
        run_refine_stream(spark, work + "/unrefined", work + "/refined", work + "/refine-ck")
        table = run_snapshots(spark, work + "/unrefined", work + "/intervals", work + "/interval-ck")
    assert read_refined(spark, work + "/refined").count() == f5_actions(spark).where(F.col("commitInfo").isNotNull()).count()
    key = ["file", "start", "end", "add_file.size"]
    got = table.intervals(table.newest()).select(*key)
    want = replay_intervals(f5_actions(spark)).select(*key)
    assert table.newest() == 1
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_refresh_from_catalog_inventory(spark, work):
    inv = spark.createDataFrame([("db", "t1", "delta", "/wh/db/t1"), ("db", "t2", "parquet", "/wh/db/t2"),
                                 ("other", "t3", "delta", "/wh/other/t3")], CATALOG_INVENTORY_SCHEMA)
    reg = RegistryStore(spark, work + "/registry")
    refresh_registry_from_catalog(spark, reg, "db", "t*", inventory=inv)
    rows = reg.current().collect()
    assert [(r.fullTableName, r.wcPath) for r in rows] == [("db.t1", "/wh/*/*/_delta_log/*.json")]


def test_run_ingest_collects_every_termination(spark, work):
    write_f5(spark, work)
    base = local_path(work)
    master = spark.createDataFrame([(f"{base}/lake/db0/t0", False, {"wildCardLevel": "-1"}),
                                    (f"{base}/lake/db1/t1", False, {"wildCardLevel": "-1"})], MASTER_SCHEMA)
    reg = RegistryStore(spark, work + "/registry")
    refresh_registry_from_config(spark, master, reg)
    c = ProgressCollector()
    qs = run_ingest(spark, reg, work + "/unrefined", work + "/ck", collector=c)
    ended = {r[2] for r in c.rows() if r[0] == "terminated"}
    assert len(qs) == 2 and {str(q.id) for q in qs} <= ended
