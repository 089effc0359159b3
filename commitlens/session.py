"""Session helpers: recommended settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the package assumes.  AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew-join splits hot keys.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # each ingest stream runs in its own pool (pool_<glob id>); pools only
    # share the executors fairly under the FAIR scheduler
    "spark.scheduler.mode": "FAIR",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "commitlens", **extra: str) -> SparkSession:
    """Build (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(RECOMMENDED_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.ui.enabled"] = "false"
    conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_work_dir(spark)
    return spark


def ensure_work_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    Reads ``spark.checkpoint.dir`` (or the directory already set on the
    context).  Only when neither is set and the master is local (local
    runs, tests) a fresh folder under the system temp dir is created and
    registered; on a cluster that is an error, as a machine-local folder
    is not shared.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="commitlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared work dir (never reused)."""
    root = ensure_work_dir(spark).rstrip("/")
    return f"{root}/commitlens/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain OS calls can use the path."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path) if path.startswith("/") else path
