"""Plan properties that the scale design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from commitlens.plans import fixtures as fx
from commitlens.plans.queries import QUERIES
from commitlens.streaming.ingest import UnrefinedStore

SF = "/root/testdata/sf0.001"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_pairwise_joins(spark, name):
    plan = physical(QUERIES[name](spark, SF))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_merge_target_is_pruned(spark, work):
    f1 = fx.commit_actions(spark, SF).drop("ingest_seq")
    store = UnrefinedStore(spark, work + "/u")
    store.land(fx.split_target(f1), "s", "r", 0)
    batch = fx.split_batch(f1).cache()
    lo = batch.agg(F.min("commitShortDate")).first()[0]
    hi = batch.agg(F.max("commitShortDate")).first()[0]
    target = store.merge_target(lo, hi)
    from commitlens.operators.merge import insert_only_merge
    plan = physical(insert_only_merge(batch, target, id_bounds=("x1", "x2")))
    assert "PartitionFilters: [" in plan and "commitShortDate" in plan
    assert "GreaterThanOrEqual(deltaLocationIdentifier,x1)" in plan
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    target_scans = [s for s in scans if "struct<deltaLocationIdentifier:string,commitVersion:bigint>" in s]
    assert target_scans, scans


def test_change_feed_prunes_sequences(spark):
    f1 = fx.stored_commit_actions(spark, SF)
    from commitlens.operators.refine import changes_since
    plan = physical(changes_since(f1, 15))
    assert "PartitionFilters: [isnotnull(ingest_seq" in plan and "(ingest_seq" in plan


def executed(df) -> str:
    """The plan that ran, after adaptive execution."""
    df._jdf.queryExecution().toRdd().count()
    return physical(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name,most", [("live_files", 8), ("live_files_incremental", 10)])
def test_snapshot_plans(spark, name, most):
    """Few scans and exchanges, and none on the table id alone: a table
    with a third of all files is dealt over many tasks."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(QUERIES[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = [re.sub(r"#\d+L?", "", k) for k in re.findall(r"\bExchange hashpartitioning\((.*?), \d+\)", plan)]
    assert keys and len(keys) <= most, keys
    assert "deltaLocationIdentifier" not in keys
    assert plan.count("FileScan") <= 3


def test_range_join_splits_a_hot_table(spark):
    """Both inputs of the range join are plain exchanges, which adaptive
    execution can split; without a hot key no task holds a whole table."""
    from commitlens.operators import snapshots as S
    from commitlens.schemas import PATH_ID

    n = 60_000
    iv = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias(PATH_ID),
        F.lit("/p").alias("data_path"), F.concat(F.lit("f"), "id").alias("file"),
        (F.col("id") % 4000).alias("start"), (F.col("id") % 4000 + 1 + F.col("id") % 37).alias("end"),
        F.struct(F.concat(F.lit("f"), "id").alias("path"), F.lit(1).alias("size")).alias("add_file"))
    nodes = S._interval_nodes(iv, S.BIN)
    per_key = nodes.groupBy(PATH_ID, "_k", "_node").count()
    total, largest = nodes.count(), per_key.agg(F.max("count")).first()[0]
    assert largest < total / 100


def test_open_intervals_meet_every_later_version(spark):
    from commitlens.operators import snapshots as S
    from commitlens.schemas import COMMIT_DATE, COMMIT_VERSION, COMMITTED_ON, PATH_ID

    rows = [("a", s, e) for s in range(0, 70, 3) for e in [None, *range(s + 1, 80, 7)]]
    iv = spark.createDataFrame([(t, "/p", f"{s}-{e}", s, e) for t, s, e in rows],
                               f"{PATH_ID} string, data_path string, file string, start long, end long")
    iv = iv.withColumn("add_file", F.struct(F.col("file").alias("path"), F.lit(1).cast("long").alias("size")))
    v = spark.range(0, 75).select(F.lit("a").alias(PATH_ID), F.col("id").alias(COMMIT_VERSION),
                                  F.current_timestamp().alias(COMMITTED_ON), F.current_date().alias(COMMIT_DATE))
    want = {(f"{s}-{e}", x) for _, s, e in rows for x in range(75) if s <= x and (e is None or x < e)}
    for b in (1, 2, 8, 1000):
        got = [(r["add_file"]["path"], r[COMMIT_VERSION]) for r in S.expand_intervals(iv, v, b).collect()]
        assert len(got) == len(set(got)) and set(got) == want
