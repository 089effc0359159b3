"""What a micro-batch of the commit-log stream costs beside its files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from commitlens.session import local_path
from commitlens.sources.commit_log import stream_commit_log


def test_batches_share_generated_code(spark, work):
    folder = f"{local_path(work)}/lake/db0/t0/_delta_log"
    os.makedirs(folder)
    for v in range(8):
        with open(f"{folder}/{v:020d}.json", "w") as f:
            f.write('{"commitInfo":{"operation":"WRITE","version":%d}}\n{"add":{"path":"p%d","size":3}}\n' % (v, v))
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    counts, rows, begun = [], [], dt.datetime.now() - dt.timedelta(seconds=1)

    def keep(batch, _):
        rows.extend(batch.select("commitVersion", F.unix_micros("updatedOn").alias("at"), "add.path").collect())
        counts.append(compiled.getCount())

    q = (stream_commit_log(spark, f"{work}/lake/*/*/_delta_log/*.json", 1).writeStream.option("checkpointLocation", f"{work}/ck")
         .trigger(availableNow=True).foreachBatch(keep).start())
    q.awaitTermination()
    assert len(counts) == 8
    assert counts[-1] == counts[3]
    # the time is that of the micro-batch, the same for its rows
    assert sorted((r.commitVersion, r.path or "") for r in rows) == sorted((v, p) for v in range(8) for p in ("", f"p{v}"))
    times = {v: {r["at"] for r in rows if r.commitVersion == v} for v in range(8)}
    assert all(len(t) == 1 for t in times.values()) and len(set.union(*times.values())) == 8
    assert all(begun.timestamp() * 1e6 < t < dt.datetime.now().timestamp() * 1e6 for t in set.union(*times.values()))
