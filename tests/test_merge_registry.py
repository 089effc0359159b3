"""Merges (J1, J2, J4, A4), registry operators (S1, S5, S6, W1) and the
refine operators (P7, T4, A3, T5) on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from commitlens.operators import merge, refine, registry
from commitlens.schemas import (
    CATALOG_INVENTORY_SCHEMA, MASTER_SCHEMA, REGISTRY_SCHEMA,
)

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def keyed(spark, rows):
    return spark.createDataFrame(rows, "deltaLocationIdentifier string, commitShortDate date, "
                                       "commitVersion long, v string")


def test_insert_only_merge_semantics(spark):
    target = keyed(spark, [("a", D1, 1, "t"), ("a", D1, 2, "t")])
    batch = keyed(spark, [("a", D1, 2, "dup"), ("a", D2, 3, "x"), ("a", D2, 3, "y"), (None, D1, 1, "n")])
    got = sorted(r.v for r in merge.insert_only_merge(batch, target).collect())
    assert got == ["n", "x", "y"]          # NULL key inserted, all actions of a commit
    empty = batch.limit(0)
    assert merge.insert_only_merge(empty, target).count() == 0
    assert merge.insert_only_merge(batch, target.limit(0)).count() == 4


def reg_rows(spark, rows, ts):
    full = [(loc, lid, wc, wid, {"wildCardLevel": "0"}, None, 0, False, ts) for loc, lid, wc, wid in rows]
    return spark.createDataFrame(full, REGISTRY_SCHEMA)


def test_registry_upsert(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    target = reg_rows(spark, [("/a", "1", "/a/*", "w1"), ("/b", "2", "/b/*", "w2")], t1)
    upd = reg_rows(spark, [("/a-new", "1", "/a-new/*", "w1"), ("/c", "3", "/c/*", "w3"),
                           ("/c", "3", "/c/*", "w3")], t2)
    got = sorted((r.deltaLocation, r.deltaLocationIdentifier, r.updatedOn)
                 for r in merge.registry_upsert(target, upd).collect())
    # matched: only updatedOn changes; new key inserted once
    assert got == [("/a", "1", t2), ("/b", "2", t1), ("/c", "3", t2)]


def test_ledger_and_marks(spark):
    ch = spark.createDataFrame([("u", 3, dt.datetime(2024, 1, 1), 1), ("u", 5, dt.datetime(2024, 1, 2), 2),
                                ("r", 1, dt.datetime(2024, 1, 3), 3)],
                               "tableName string, latestVersion long, updatedOn timestamp, _seq long")
    cur = {r.tableName: r.latestVersion for r in merge.ledger_current(ch).collect()}
    assert cur == {"u": 5, "r": 1}
    assert merge.high_water_mark(ch, "u") == 5
    assert merge.high_water_mark(ch, "missing") == 0
    names = spark.createDataFrame([("u",), ("zz",)], "tableName string")
    assert sorted((r.tableName, r.latestVersion) for r in merge.high_water_marks(ch, names).collect()) == \
        [("u", 5), ("zz", 0)]


def test_config_scan(spark):
    rows = [("/a", False, {"wildCardLevel": "0"}), ("/b", True, {"wildCardLevel": "0"}),
            ("/c", None, {"wildCardLevel": "0"})]
    got = [r.deltaLocation for r in registry.config_scan(spark.createDataFrame(rows, MASTER_SCHEMA)).collect()]
    assert got == ["/a"]
    bad = spark.createDataFrame([("/a", False, {"x": "1"})], MASTER_SCHEMA)
    with pytest.raises(registry.ConfigError):
        registry.config_scan(bad)


def test_catalog_pattern_like_list_tables(spark):
    inv = spark.createDataFrame([("default", "alpha_x", "delta", "/w/ax"), ("default", "alpha_y", "delta", "/w/ay"),
                                 ("default", "beta", "delta", "/w/b"), ("other", "alpha_z", "delta", "/w/az"),
                                 ("default", "alpha_p", "parquet", "/w/ap")], CATALOG_INVENTORY_SCHEMA)

    def names(db, pat):
        return sorted(r.fullTableName for r in registry.catalog_filter(inv, db, pat).collect())
    assert names("default", "ALPHA*") == ["default.alpha_x", "default.alpha_y"]
    assert names("default", "alpha_x|beta") == ["default.alpha_x", "default.beta"]
    assert names("default", "al") == []
    assert names(" ; ", "  ") == ["default.alpha_x", "default.alpha_y", "default.beta", "other.alpha_z"]
    assert names("default:other", "*_z") == ["other.alpha_z"]


def test_resolve_locations(spark):
    inv = spark.createDataFrame([("sales", "orders", "delta", "/wh/sales/orders"),
                                 ("sales", "raw", "parquet", "/wh/sales/raw"),
                                 ("empty", "x", "parquet", "/wh/empty/x")], CATALOG_INVENTORY_SCHEMA)
    entries = spark.createDataFrame([("sales",), ("empty",), ("/wh/sales/orders",), ("Sales.Orders",)], "entry string")
    got = sorted((r.entry, r.fullTableName, r.deltaLocation)
                 for r in registry.resolve_locations(entries, inv).collect())
    assert got == [("/wh/sales/orders", None, "/wh/sales/orders"),
                   ("Sales.Orders", "Sales.Orders", "/wh/sales/orders"),
                   ("sales", "sales.orders", "/wh/sales/orders")]
    mixed = spark.createDataFrame([("SALES",), ("Orders",)], "entry string")
    got = sorted((r.entry, r.fullTableName, r.deltaLocation)
                 for r in registry.resolve_locations(mixed, inv, current_db="Sales").collect())
    assert got == [("Orders", "Orders", "/wh/sales/orders"), ("SALES", "sales.orders", "/wh/sales/orders")]
    bad = spark.createDataFrame([("sales.raw",), ("/nope",)], "entry string")
    with pytest.raises(registry.ConfigError, match="sales.raw"):
        registry.resolve_locations(bad, inv)


def test_resolve_empty_databases_and_identifiers(spark, work):
    """A database without tables stands for nothing and does not raise;
    identifiers are read as a catalog reads them; carried columns stay."""
    inv = spark.createDataFrame([("sales", "orders", "delta", "/wh/sales/orders"),
                                 ("sales", "odd name", "delta", "/wh/sales/odd")], CATALOG_INVENTORY_SCHEMA)
    dbs = spark.createDataFrame([("sales",), ("void",)], "db string")
    entries = spark.createDataFrame([("Void", 1), ("spark_catalog.SALES.orders", 2), ("`sales`.`odd name`", 3), ("`sales`", 4),
                                     ("/wh/sales/odd", 5), ("/wh/sales/odd", 6)], "entry string, extra int")
    got = sorted((r.extra, r.fullTableName, r.deltaLocation) for r in
                 registry.resolve_locations(entries, inv, databases=dbs).collect())
    assert got == [(2, "spark_catalog.SALES.orders", "/wh/sales/orders"), (3, "`sales`.`odd name`", "/wh/sales/odd"),
                   (4, "sales.odd name", "/wh/sales/odd"), (4, "sales.orders", "/wh/sales/orders"),
                   (5, None, "/wh/sales/odd"), (6, None, "/wh/sales/odd")]
    with pytest.raises(registry.ConfigError, match="Void"):  # unknown unless the databases are given
        registry.resolve_locations(entries, inv)
    assert registry.resolve_locations(entries.limit(0), inv, databases=dbs).count() == 0


def test_empty_database_of_the_session_catalog(spark, work):
    from commitlens.plans.jobs import resolve_config
    from commitlens.schemas import MASTER_SCHEMA

    spark.sql("CREATE DATABASE IF NOT EXISTS cl_void")
    rows = spark.createDataFrame([("CL_void", False, {"wildCardLevel": "0"})], MASTER_SCHEMA)
    assert resolve_config(spark, rows).count() == 0
    spark.sql("DROP DATABASE cl_void")


def test_stream_slice_bounds(spark):
    reg = reg_rows(spark, [(f"/t{i}", str(i), f"/t{i}/*", f"w{i:02d}") for i in range(10)], dt.datetime(2024, 1, 1))
    got = [(r.path_id, r.slice_row) for r in registry.stream_slice(reg, 3, 5).orderBy("slice_row").collect()]
    assert got == [("w02", 3), ("w03", 4), ("w04", 5)]
    assert registry.stream_slice(reg, 11, 20).count() == 0


def test_refine_operators(spark):
    from commitlens.plans import fixtures as fx

    f1 = fx.commit_actions(spark, "/root/testdata/sf0.001")
    flat = refine.flatten_commit_info(f1)
    assert "version" not in flat.columns and "timestamp" not in flat.columns
    assert flat.count() == f1.where(F.col("commitInfo").isNotNull()).count()
    # T5 in two increments equals one run
    mid = 12
    first, _ = refine.incremental_refine(f1.where(F.col("ingest_seq") <= mid), None, 0)
    second, mark = refine.incremental_refine(f1, first, mid)
    once, _ = refine.incremental_refine(f1, None, 0)
    key = ["deltaLocationIdentifier", "commitVersion"]
    assert sorted(first.select(*key).union(second.select(*key)).collect()) == sorted(once.select(*key).collect())
    assert mark.first()["latest_version"] == f1.agg(F.max("ingest_seq")).first()[0]
    # replaying the same increment inserts nothing
    again, _ = refine.incremental_refine(f1, first.unionByName(second), mid)
    assert again.count() == 0


def test_inventory_from_session_catalog(spark, work):
    from commitlens.session import local_path

    spark.sql("CREATE DATABASE IF NOT EXISTS cl_inv")
    for t in ("alpha_x", "beta"):
        spark.sql(f"CREATE TABLE IF NOT EXISTS cl_inv.{t} (a INT) USING parquet "
                  f"LOCATION '{local_path(work)}/{t}'")
    spark.range(1).createOrReplaceTempView("alpha_tmp")
    inv = registry.inventory_from_catalog(spark, ["cl_inv"])
    got = sorted((r.db, r.table, r.provider) for r in inv.collect())
    assert got == [("cl_inv", "alpha_x", "parquet"), ("cl_inv", "beta", "parquet")]
    sel = registry.catalog_filter(inv, "cl_inv", "ALPHA*", provider="parquet").collect()
    assert [r.fullTableName for r in sel] == ["cl_inv.alpha_x"]
    assert sel[0].deltaLocation.endswith("/alpha_x")


def test_stream_slice_by_location(spark):
    reg = reg_rows(spark, [(f"/t{i}", f"{i:02d}", f"/t{i}/*", "w") for i in range(5)], dt.datetime(2024, 1, 1))
    got = [(r.path, r.path_id) for r in registry.stream_slice(reg, 1, 2, use_wildcard_path=False)
           .orderBy("slice_row").collect()]
    assert got == [("/t0/_delta_log/*.json", "00"), ("/t1/_delta_log/*.json", "01")]


def test_split_wildcards_null_path_in_neither(spark):
    rows = spark.createDataFrame([("/a/**", False, {"wildCardLevel": "0"}), (None, False, {"wildCardLevel": "0"}),
                                  ("/b", False, {"wildCardLevel": "1"})], MASTER_SCHEMA)
    wild, plain = registry.split_wildcards(rows)
    assert [r.deltaLocation for r in wild.collect()] == ["/a/"]
    assert [r.deltaLocation for r in plain.collect()] == ["/b"]


def test_registry_current_truncation(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    a = merge.registry_changes(reg_rows(spark, [("/a", "1", "/a/*", "w1")], t1), 1)
    b = merge.registry_changes(reg_rows(spark, [("/b", "2", "/b/*", "w2")], t2), 2)
    ch = a.unionByName(b)
    assert merge.registry_current(ch).count() == 2
    assert [r.deltaLocation for r in merge.registry_current(ch, truncated_before=2).collect()] == ["/b"]


def test_levels_from_config(spark):
    from commitlens.functions.paths import config_level, wildcard_path

    rows = spark.createDataFrame([("/a/b/c", {"wildCardLevel": "x"}), ("/a/b/c", {}), ("/a/b/c", {"wildCardLevel": " 1"})],
                                 "deltaLocation string, extraConfig map<string,string>")
    got = [(r.lv, r.g) for r in rows.select(config_level("extraConfig").alias("lv"),
                                            wildcard_path("deltaLocation", config_level("extraConfig")).alias("g")).collect()]
    assert got[0] == (None, None) and got[1] == (None, None)
    assert got[2] == (1, "/a/*/*/_delta_log/*.json")


def test_registry_rows_require_level_through_config_scan(spark):
    bad = spark.createDataFrame([("/a", False, {})], MASTER_SCHEMA)
    with pytest.raises(registry.ConfigError, match="wildCardLevel"):
        registry.config_scan(bad)
