"""Commit-log sources: JSON commit files read with a fixed schema, as a
stream (S7/T1) or as a batch twin, and the enrichment both share
(P1, P4, P5).  The schema is never inferred, so no sampling pass runs
over millions of small files."""

from __future__ import annotations

import logging
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.functions.paths import (
    commit_file_location, commit_file_version, normalize_location, path_identity,
)
from commitlens.schemas import (
    ACTION_FIELDS, ACTION_SCHEMA, COMMIT_DATE, COMMIT_VERSION, COMMITTED_ON, FILE_NAME,
    PATH, PATH_ID, UPDATED_ON,
)

log = logging.getLogger(__name__)

DEFAULT_MAX_FILES_PER_TRIGGER = 1024   # T7, reference default
COMMIT_FILES = "*.json"
#: Files of one listing that an interval trigger keeps for its next micro-batches (Spark: 10,000).
MAX_CACHED_FILES = 200_000
GLOB_CHARACTER = re.compile(r"[{}\[\]*?\\]")
LISTING_CONF = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LOG_CONF = "spark.sql.streaming.fileSource.log.compactInterval"
OPEN_CONF = "spark.sql.files.openCostInBytes"


def set_listing(spark: SparkSession) -> None:
    """Listing jobs of a task a core, a file log that is written
    anew every 100 micro-batches and read tasks of up to 128 commit files
    (128 MB at a megabyte a file to open), where the session has no values of
    its own.  Spark's defaults are one task per path up to 10,000, every 10
    and 32 files a task."""
    for conf, value in ((LISTING_CONF, spark.sparkContext.defaultParallelism), (LOG_CONF, 100), (OPEN_CONF, 1 << 20)):
        if spark.conf.get(conf, None) is None:
            spark.conf.set(conf, str(value))


def batch_time() -> Column:
    """``current_timestamp``, kept out of the code that Spark generates.

    The time is a constant of its micro-batch.  Written into the generated
    code it would make that of every batch a new one, to be compiled on both
    sides again; a lambda's argument is handed over beside the code."""
    return F.transform(F.array(F.current_timestamp()), lambda t: t)[0]


def with_commit_columns(df: DataFrame, file_col: Column | None = None,
                        mtime_col: Column | None = None, normalize: bool = True) -> DataFrame:
    """T1 enrichment: file name -> table location, id and version;
    file modification time -> commit time and date; ``updatedOn`` is the
    time the micro-batch runs (not the time the stream was defined).

    ``file_col``/``mtime_col`` default to ``_metadata`` of a file source.
    """
    fcol = file_col if file_col is not None else F.col("_metadata.file_path")
    tcol = mtime_col if mtime_col is not None else F.col("_metadata.file_modification_time")
    out = df.withColumn(FILE_NAME, fcol).withColumn(COMMITTED_ON, tcol.cast("timestamp"))
    loc = commit_file_location(F.col(FILE_NAME))
    out = out.withColumn(PATH, normalize_location(loc, encoded=True) if normalize else loc)
    out = out.withColumn(PATH_ID, path_identity(PATH))
    out = out.withColumn(COMMIT_VERSION, commit_file_version(F.col(FILE_NAME)))
    out = out.withColumn(UPDATED_ON, batch_time())
    out = out.withColumn(COMMIT_DATE, F.to_date(COMMITTED_ON))
    if "_metadata" in out.columns:
        out = out.drop("_metadata")
    return out.select(*ACTION_FIELDS, FILE_NAME, PATH, PATH_ID, COMMIT_VERSION,
                      UPDATED_ON, COMMITTED_ON, COMMIT_DATE)


def stream_commit_log(spark: SparkSession, glob: str,
                      max_files_per_trigger: int | str = DEFAULT_MAX_FILES_PER_TRIGGER,
                      ) -> DataFrame | None:
    """S7 + T1: streaming DataFrame of enriched actions under ``glob``.

    A definition error (e.g. a missing non-glob path) is logged and the
    glob is skipped (``None``); a glob that matches nothing yields an
    empty stream.

    A glob ``<folders>/*.json`` is listed by its folders, with the file
    pattern as a filter: Spark looks up every path that a glob matches once
    more, so that folders cost one call a table and files one a commit.
    """
    set_listing(spark)
    reader = (spark.readStream.schema(ACTION_SCHEMA).option("maxFilesPerTrigger", str(max_files_per_trigger))
              .option("maxCachedFiles", str(MAX_CACHED_FILES)))
    folders, _, name = glob.rpartition("/")
    if name == COMMIT_FILES and GLOB_CHARACTER.search(folders):
        reader, glob = reader.option("pathGlobFilter", COMMIT_FILES), folders
    try:
        raw = reader.json(glob).select("*", "_metadata")
    except Exception as exc:  # noqa: BLE001 -- reference behaviour: log and skip
        log.error("cannot stream commit log at %s: %s", glob, exc)
        return None
    return with_commit_columns(raw)


def read_commit_log(spark: SparkSession, globs: list[str]) -> DataFrame:
    """Batch twin of ``stream_commit_log`` over several globs.

    A batch read fails on a glob that matches nothing, so such globs
    are dropped first (a metadata glob per entry, no data is read).
    """
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    live = []
    for g in globs:
        p = jvm.org.apache.hadoop.fs.Path(g)
        st = p.getFileSystem(hconf).globStatus(p)
        if st is not None and len(st) > 0:
            live.append(g)
    if not live:
        empty = spark.createDataFrame([], ACTION_SCHEMA)
        return with_commit_columns(empty, F.lit(None).cast("string"), F.lit(None).cast("timestamp"))
    raw = spark.read.schema(ACTION_SCHEMA).json(live).select("*", "_metadata")
    return with_commit_columns(raw)
