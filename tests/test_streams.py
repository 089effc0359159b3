"""Commit files on disk (F5): discovery, streams, the storage protocol,
the refine job and the listener."""

import datetime as dt
import os

from pyspark.sql import functions as F

from commitlens.plans import fixtures as fx
from commitlens.schemas import MASTER_SCHEMA, PATH
from commitlens.session import local_path
from commitlens.sources.commit_log import read_commit_log, stream_commit_log
from commitlens.plans.commit_files import write_commit_files
from commitlens.sources.discovery import discover_tables
from commitlens.streaming.ingest import (
    UnrefinedStore, await_all, start_ingest_stream, trigger_for,
)
from commitlens.streaming.progress import ProgressCollector
from commitlens.streaming.refine_job import ProcessedLedger, read_refined, run_incremental_refine

SF = "/root/testdata/sf0.001"
ALL = "/lake/*/*/_delta_log/*.json"


def f5_actions(spark):
    f1 = fx.commit_actions(spark, SF)
    return f1.where(F.col(PATH).rlike("/t[0-2]$"))


def write_f5(spark, work, until=None):
    acts = f5_actions(spark)
    if until is not None:
        acts = acts.where(F.col("committedOn") < F.lit(until).cast("timestamp"))
    write_commit_files(acts, work).count()
    return acts


def extra_cases(root):
    r = local_path(root)
    odd = f"{r}/lake/db0/t 2+x/_delta_log"
    os.makedirs(odd, exist_ok=True)
    with open(f"{odd}/00000000000000000000.json", "w") as fh:
        fh.write('{"commitInfo":{"operation":"WRITE"}}\n{"add":{"path":"p0","size":3}}\nnot json\n')
    with open(f"{odd}/00000000000000000000.00000000000000000001.compacted.json", "w") as fh:
        fh.write('{"add":{"path":"p1","size":4}}\n')
    os.makedirs(f"{r}/lake/db1/empty", exist_ok=True)
    nested = f"{r}/lake/db2/t2/_delta_log/x"
    os.makedirs(nested, exist_ok=True)
    with open(f"{nested}/y.json", "w") as fh:
        fh.write('{"txn":{"appId":"a","version":1}}\n')


def test_discovery(spark, work):
    write_f5(spark, work)
    extra_cases(work)
    base = local_path(work)
    rows = spark.createDataFrame([(f"{base}/lake", False, {"wildCardLevel": "1"})], MASTER_SCHEMA)
    got = {r.deltaLocation[len(base):] for r in discover_tables(rows).collect()}
    assert got == {"/lake/db0/t0", "/lake/db1/t1", "/lake/db2/t2",
                   "/lake/db0/t 2+x", "/lake/db2/t2/_delta_log"}
    strict = {r.deltaLocation[len(base):] for r in discover_tables(rows, strict=True).collect()}
    assert "/lake/db2/t2/_delta_log" not in strict and "/lake/db0/t 2+x" in strict


def test_expand_wildcards_keeps_parent_settings(spark, work):
    from commitlens.operators.registry import expand_wildcards

    write_f5(spark, work)
    base = local_path(work)
    rows = spark.createDataFrame([(f"{base}/lake/**", False, {"wildCardLevel": "0"}),
                                  ("/plain/t", False, {"wildCardLevel": "-1"})], MASTER_SCHEMA)
    got = {(r.deltaLocation.replace(base, ""), r.extraConfig["wildCardLevel"]) for r in expand_wildcards(rows).collect()}
    assert got == {("/lake/db0/t0", "0"), ("/lake/db1/t1", "0"), ("/lake/db2/t2", "0"), ("/plain/t", "-1")}


def test_stream_enrichment_and_mtime(spark, work):
    acts = write_f5(spark, work)
    extra_cases(work)
    out = work + "/out"
    q = (stream_commit_log(spark, work + ALL, 4).writeStream.format("parquet")
         .option("checkpointLocation", out + "/_cp").trigger(availableNow=True).start(out + "/data"))
    await_all([q])
    got = spark.read.parquet(out + "/data")
    base = local_path(work)
    # every F5 action once, ids computed on the decoded, scheme-less path
    t = got.where(F.col(PATH).rlike("/t[0-2]$"))
    assert t.count() == acts.count()
    r = t.where(F.col("commitInfo").isNotNull()).orderBy("deltaLocation", "commitVersion").first()
    assert r.deltaLocation.startswith(base + "/lake/")
    src = acts.where(F.col("commitInfo").isNotNull()).orderBy("deltaLocation", "commitVersion").first()
    assert r.committedOn == src.committedOn.replace(microsecond=0)
    odd = got.where(F.col(PATH) == f"{base}/lake/db0/t 2+x")
    assert odd.count() == 4                                     # 3 lines + compacted file
    assert odd.where(F.col("commitVersion").isNull()).count() == 1
    assert odd.where(F.col("commitInfo").isNull() & F.col("add").isNull()).count() == 1  # malformed line


def test_no_match_glob_is_empty(spark, work):
    q = (stream_commit_log(spark, work + "/nothing/*/_delta_log/*.json").writeStream.format("memory")
         .queryName("nomatch").trigger(availableNow=True).start())
    await_all([q])
    assert spark.table("nomatch").count() == 0
    assert read_commit_log(spark, [work + "/nothing/*.json"]).count() == 0


def test_stream_lists_folders_not_files(spark, work):
    """One lookup a table, not one a commit; what is read stays the same."""
    acts = write_f5(spark, work)
    extra_cases(work)
    os.makedirs(f"{local_path(work)}/lake/db0/t0/_delta_log/nested")
    for name in ("nested/00000000000000000009.json", "00000000000000000009.txt"):
        with open(f"{local_path(work)}/lake/db0/t0/_delta_log/{name}", "w") as f:
            f.write('{"commitInfo":{"operation":"WRITE"}}\n')
    q = (stream_commit_log(spark, work + ALL).writeStream.format("memory").queryName("listed").trigger(availableNow=True).start())
    await_all([q])
    assert q.lastProgress.sources[0].description.endswith("/_delta_log]")
    got = spark.table("listed")
    assert got.where(F.col(PATH).rlike("/t[0-2]$")).count() == acts.count()
    assert got.where("file_name like '%nested%' or file_name like '%.txt'").count() == 0
    one = stream_commit_log(spark, f"{work}/lake/db0/t0/_delta_log/*.json")
    q = one.writeStream.format("memory").queryName("one").trigger(availableNow=True).start()
    await_all([q])
    assert spark.table("one").count() == got.where(F.col(PATH).endswith("/db0/t0")).count()


def test_ingest_exactly_once_and_restart(spark, work):
    split = dt.datetime(2024, 1, 20)
    write_f5(spark, work, until=split)
    root, ck = work + "/unrefined", work + "/ck"
    store = UnrefinedStore(spark, root)

    def run():
        await_all([start_ingest_stream(spark, work + ALL, "all", root, ck, max_files_per_trigger=7),
                   start_ingest_stream(spark, work + "/lake/db0/*/_delta_log/*.json", "db0", root, ck,
                                       max_files_per_trigger=5)])

    run()
    first = f5_actions(spark).where(F.col("committedOn") < F.lit(split)).count()
    assert store.read().count() == first
    marks = store.marks()
    assert len(marks) == 2
    run()                                   # nothing new: no rows, no batches
    assert store.read().count() == first and store.marks() == marks
    write_f5(spark, work)                   # all commits (rewrites old files with equal content)
    run()
    total = f5_actions(spark).count()
    assert store.read().count() == total
    key = ["deltaLocationIdentifier", "commitShortDate", "commitVersion", "file_name"]
    assert store.read().groupBy(*key).count().where("count > 3").count() == 0


def test_half_written_batches_and_replays(spark, work):
    root = work + "/unrefined"
    store = UnrefinedStore(spark, root)
    batch = read_commit_log(spark, []).limit(0)
    f1 = fx.commit_actions(spark, SF).drop("ingest_seq").limit(50).cache()
    assert store.read().count() == 0
    assert store.land(f1, "s", "r", 0)
    # what a crashed attempt left under the next batch stays invisible ...
    debris = store.folder("merge", "s", "r", 1)
    f1.limit(5).write.mode("overwrite").partitionBy("commitShortDate").parquet(debris)
    os.remove(f"{local_path(debris)}/_SUCCESS")
    assert store.read().count() == 50 and store.marks() == {("merge", "s", "r"): 0}
    # ... and the replay replaces it as a whole
    assert store.land(batch, "s", "r", 1)
    assert store.read().count() == 50 and store.marks() == {("merge", "s", "r"): 1}
    # a complete batch is not written again
    assert not store.land(f1, "s", "r", 0) and store.read().count() == 50


def test_fresh_checkpoint_loses_nothing(spark, work):
    split = dt.datetime(2024, 1, 20)
    root, ck = work + "/unrefined", work + "/ck"
    store = UnrefinedStore(spark, root)
    write_f5(spark, work, until=split)
    await_all([start_ingest_stream(spark, work + ALL, "all", root, ck)])
    before = store.read().count()
    write_f5(spark, work)
    await_all([start_ingest_stream(spark, work + ALL, "all", root, ck, checkpoint_suffix="_2")])
    assert before < store.read().count() == f5_actions(spark).count()
    await_all([start_ingest_stream(spark, work + ALL, "all", root, ck, checkpoint_suffix="_3")])
    assert store.read().count() == f5_actions(spark).count()


def test_two_jobs_inside_one_batch(spark, work):
    """Two stores on one root, spelled differently, land at the same time:
    neither sees the other, both write the shared commits, readers keep one."""
    root = local_path(work) + "/unrefined"
    one, two = UnrefinedStore(spark, root), UnrefinedStore(spark, "file:" + root)
    f1 = fx.commit_actions(spark, SF).drop("ingest_seq").cache()
    left, right = f1.where("commitVersion % 3 < 2"), f1.where("commitVersion % 3 > 0")

    class Late(UnrefinedStore):
        """Lands the other job's batch between its own target and its write."""

        def _write(self, rows, folder):
            two.land(right, "b", "r2", 0)
            super()._write(rows, folder)

    assert Late(spark, root).land(left, "a", "r1", 0)
    assert one.marks() == {("merge", "a", "r1"): 0, ("merge", "b", "r2"): 0}
    assert one._landed(one.marks()).count() > f1.count()
    cols = ["file_name", "deltaLocationIdentifier", "commitShortDate", "commitVersion",
            F.to_json(F.struct("commitInfo", "add", "remove")).alias("j")]
    got = one.read().select(*cols)
    assert got.exceptAll(f1.select(*cols)).count() == 0 and f1.select(*cols).exceptAll(got).count() == 0
    # the change feed names a commit once as well, whichever run's mark it follows
    assert one.read_since({}).count() == f1.count()
    assert one.read_since({("merge", "a", "r1"): 0}).count() == right.count()


def test_append_mode_lands_where_refine_reads(spark, work):
    acts = write_f5(spark, work)
    root, refined, ledger = work + "/unrefined", work + "/refined", work + "/processed"
    for suffix in ("", "_2"):                # append does not look for earlier rows
        await_all([start_ingest_stream(spark, work + ALL, "all", root, work, checkpoint_suffix=suffix,
                                       append_mode=True)])
    assert UnrefinedStore(spark, root).read().count() == 2 * acts.count()
    await_all([start_ingest_stream(spark, work + ALL, "all", root, work, checkpoint_suffix="_3")])
    assert UnrefinedStore(spark, root).read().count() == 2 * acts.count()
    assert len(run_incremental_refine(spark, root, refined, ledger)) == 3
    assert read_refined(spark, refined).select("deltaLocation", "commitVersion").distinct().count() == \
        acts.where(F.col("commitInfo").isNotNull()).count()


def test_refine_job(spark, work):
    write_f5(spark, work)
    root, ck = work + "/unrefined", work + "/ck"
    await_all([start_ingest_stream(spark, work + ALL, "all", root, ck, max_files_per_trigger=11)])
    refined, ledger = work + "/refined", work + "/processed"
    mark = run_incremental_refine(spark, root, refined, ledger)
    assert mark == UnrefinedStore(spark, root).marks()
    n = read_refined(spark, refined).count()
    assert n == f5_actions(spark).where(F.col("commitInfo").isNotNull()).count()
    assert run_incremental_refine(spark, root, refined, ledger) == mark
    assert read_refined(spark, refined).count() == n
    assert ProcessedLedger(spark, ledger).marks("unrefined_metrics") == mark


def test_trigger_for():
    assert trigger_for(None) == {"availableNow": True}
    assert trigger_for("AvailableNow") == {"availableNow": True}
    assert trigger_for("ONCE") == {"availableNow": True}
    assert trigger_for("5 minutes") == {"processingTime": "5 minutes"}


def test_listener(spark, work):
    import time

    acts = write_f5(spark, work)
    c = ProgressCollector()
    spark.streams.addListener(c)
    try:
        await_all([start_ingest_stream(spark, work + ALL, "lst", work + "/u", work + "/ck",
                                       max_files_per_trigger=50)])
        deadline = time.time() + 30
        while time.time() < deadline and not any(r[0] == "terminated" for r in c.rows()):
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(c)
    ev = c.to_dataframe(spark)
    kinds = {r.event for r in ev.collect()}
    assert {"started", "progress", "terminated"} <= kinds
    assert ev.where("event = 'progress'").agg(F.sum("num_input_rows")).first()[0] == acts.count()
    assert ev.where("event = 'started'").first().name == "query_lst"


def test_null_date_rows_reach_the_change_feed(spark, work):
    root = work + "/unrefined"
    store = UnrefinedStore(spark, root)
    f1 = fx.commit_actions(spark, SF).drop("ingest_seq").limit(20)
    nulls = f1.limit(3).withColumn("commitShortDate", F.lit(None).cast("date")) \
        .withColumn("commitVersion", F.col("commitVersion") + 100000)
    assert store.land(f1.unionByName(nulls), "s", "r", 0)
    assert store.read_since({}).count() == 23
    assert store.read().count() == 23


def test_refine_two_increments_equal_one(spark, work):
    split = dt.datetime(2024, 1, 18)
    write_f5(spark, work, until=split)
    root, ck = work + "/unrefined", work + "/ck"
    refined, ledger = work + "/refined", work + "/processed"
    await_all([start_ingest_stream(spark, work + ALL, "all", root, ck, max_files_per_trigger=13)])
    m1 = run_incremental_refine(spark, root, refined, ledger)
    write_f5(spark, work)
    await_all([start_ingest_stream(spark, work + ALL, "all", root, ck, max_files_per_trigger=13)])
    m2 = run_incremental_refine(spark, root, refined, ledger)
    assert m2.keys() == m1.keys() and max(m2.values()) > max(m1.values())
    got = read_refined(spark, refined).select("deltaLocationIdentifier", "commitVersion")
    assert got.count() == got.distinct().count()
    want = f5_actions(spark).where(F.col("commitInfo").isNotNull()).count()
    assert got.count() == want


def test_merge_on_id_and_version_ignores_touched_files(spark, work):
    """Q7: a commit file touched later gets a new date; the default key
    inserts it again, (id, version) does not."""
    acts = write_f5(spark, work)
    base = local_path(work)
    f = f"{base}/lake/db0/t0/_delta_log/{0:020d}.json"
    key_id_version = ["deltaLocationIdentifier", "commitVersion"]
    orig = os.stat(f).st_mtime
    stamp = dt.datetime(2024, 3, 1).timestamp()
    lines = sum(1 for _ in open(f))
    for keys, extra in ((key_id_version, 0), (None, 1)):
        os.utime(f, (orig, orig))
        root, ck = f"{work}/u-{extra}", f"{work}/ck-{extra}"
        kw = {"merge_keys": keys} if keys else {}
        await_all([start_ingest_stream(spark, work + ALL, "a", root, ck, **kw)])
        n0 = UnrefinedStore(spark, root).read().count()
        assert n0 == acts.count()
        os.utime(f, (stamp, stamp))          # the log file is touched (new date)
        # a new stream (new checkpoint) re-reads every file, as after a log copy
        await_all([start_ingest_stream(spark, work + ALL, "b", root, ck, **kw)])
        n1 = UnrefinedStore(spark, root).read().count()
        assert n1 == n0 + extra * lines


def test_processing_time_trigger(spark, work):
    write_f5(spark, work)
    q = start_ingest_stream(spark, work + ALL, "pt", work + "/u", work + "/ck",
                            trigger_interval="1 second", max_files_per_trigger=100)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert UnrefinedStore(spark, work + "/u").read().count() == f5_actions(spark).count()


def test_batch_twin_equals_stream(spark, work):
    write_f5(spark, work)
    extra_cases(work)
    out = work + "/out"
    q = (stream_commit_log(spark, work + ALL, 50).writeStream.format("parquet")
         .option("checkpointLocation", out + "/_cp").trigger(availableNow=True).start(out + "/data"))
    await_all([q])
    cols = ["file_name", "deltaLocation", "deltaLocationIdentifier", "commitVersion", "committedOn",
            "commitShortDate"]
    key = F.to_json(F.struct("commitInfo", "add", "remove", "txn")).alias("j")
    streamed = spark.read.parquet(out + "/data").select(*cols, key)
    batch = read_commit_log(spark, [work + ALL, work + "/nothing/*.json"]).select(*cols, key)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_missing_wildcard_directory_fails(spark, work):
    import pytest
    from commitlens.operators.registry import expand_wildcards

    rows = spark.createDataFrame([(f"{local_path(work)}/no-such-dir/**", False, {"wildCardLevel": "0"})],
                                 MASTER_SCHEMA)
    with pytest.raises(FileNotFoundError, match="no-such-dir"):
        expand_wildcards(rows)


def test_commit_files_survive_small_batches(spark, work):
    """No line is lost where an Arrow batch ends inside a commit."""
    actions = fx.commit_actions(spark, SF).drop("ingest_seq")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        written = write_commit_files(actions, work).agg(F.sum("lines")).first()[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    on_disk = spark.read.text(work + ALL).count()
    assert written == on_disk == actions.count()


def test_discovery_through_hadoop_file_systems(spark, work):
    """A scheme that only the session's Hadoop settings know."""
    import pytest
    from commitlens.operators.registry import expand_wildcards
    from commitlens.sources.discovery import table_paths

    write_f5(spark, work)
    extra_cases(work)
    base = local_path(work)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.lakes.link./mnt", f"file://{base}")
    rows = spark.createDataFrame([("viewfs://lakes/mnt/lake/**", False, {"wildCardLevel": "1"}),
                                  (f"{base}/lake/**", False, {"wildCardLevel": "0"})], MASTER_SCHEMA)
    got = [r.deltaLocation for r in expand_wildcards(rows).collect()]
    far = sorted(p[len("viewfs://lakes/mnt"):] for p in got if p.startswith("viewfs"))
    near = sorted(p[len(base):] for p in got if not p.startswith("viewfs"))
    assert far == near and "/lake/db0/t 2+x" in far
    some = spark.createDataFrame([("viewfs://lakes/mnt/lake/db0/t0",), ("viewfs://lakes/mnt/lake/db0/none",), (f"{base}/lake/db1/t1",)],
                                 "deltaLocation string")
    assert {r.location for r in table_paths(some).collect()} == {"viewfs://lakes/mnt/lake/db0/t0", f"{base}/lake/db1/t1"}
    gone = spark.createDataFrame([("viewfs://lakes/mnt/nothing/**", False, {"wildCardLevel": "1"})], MASTER_SCHEMA)
    with pytest.raises(FileNotFoundError, match="viewfs://lakes/mnt/nothing"):
        expand_wildcards(gone)
    odd = spark.createDataFrame([("nosuchscheme://x/y/**", False, {"wildCardLevel": "1"})], MASTER_SCHEMA)
    with pytest.raises(Exception, match="nosuchscheme"):
        expand_wildcards(odd).count()


def test_progress_stays_bounded():
    from types import SimpleNamespace

    c = ProgressCollector(keep=3)
    for n in range(10):
        c.onQueryProgress(SimpleNamespace(progress=SimpleNamespace(
            name="q", id="i", runId="r", timestamp=str(n), batchId=n, numInputRows=n + 1, inputRowsPerSecond=1.0, processedRowsPerSecond=1.0)))
    rows = c.rows()
    assert len(rows) == 4 and sum(r[6] for r in rows) == 55 and [r[5] for r in rows] == [None, 7, 8, 9]


def test_a_micro_batch_of_the_default_size_is_read_by_few_tasks(spark, work):
    """1,024 commit files are read 128 a task, not 32."""
    root = local_path(work)
    for t in range(4):
        os.makedirs(f"{root}/db/t{t}/_delta_log")
        for v in range(256):
            with open(f"{root}/db/t{t}/_delta_log/{v:020d}.json", "w") as f:
                f.write('{"add":{"path":"p"}}\n')
    out = work + "-out"
    q = (stream_commit_log(spark, f"{root}/db/*/_delta_log/*.json").writeStream.format("parquet")
         .option("checkpointLocation", out + "/_checkpoint").trigger(availableNow=True).start(out + "/data"))
    q.awaitTermination()
    written = [f for f in os.listdir(local_path(out) + "/data") if f.endswith(".parquet")]
    assert spark.read.parquet(out + "/data").count() == 1024 and len(written) <= 9
