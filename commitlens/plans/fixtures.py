"""Fixtures F1-F4 (see FIXTURES.md), built by Spark from the given tables.

Each Spark builder has a twin SQL fragment (``*_CTE``) that DuckDB runs
on the same parquet views for the oracle check.  The Spark side nests
actions into the structs of ``ACTION_SCHEMA``; the SQL side stays flat.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.functions.paths import path_identity
from commitlens.functions.sequence import bucketed_row_number
from commitlens.schemas import (
    ACTION_SCHEMA, COMMIT_DATE, COMMIT_VERSION, COMMITTED_ON, EXTRA_CONFIG, FILE_NAME,
    IGNORE, INGEST_SEQ, PATH, PATH_ID, UPDATED_ON, WILDCARD_LEVEL,
)

# Fixed fixture values (FIXTURES.md).
OPERATION_OF_EVENT = [("click", "WRITE"), ("view", "UPDATE"), ("purchase", "MERGE"),
                      ("signup", "OPTIMIZE"), ("error", "DELETE")]
REMOVING_OPERATIONS = ["UPDATE", "MERGE", "OPTIMIZE", "DELETE"]
FIXTURE_UPDATED_ON = dt.datetime(2024, 2, 1)
SPLIT_TARGET_BEFORE = "2024-01-16"       # F3 target: ts < this
SPLIT_BATCH_FROM = "2024-01-10"          # F3 batch: ts >= this
INGEST_EPOCH = "2024-01-01"              # ingest_seq = days since + 1
REGISTRY_TARGET_UPDATED = dt.datetime(2024, 1, 20)
REGISTRY_BATCH_UPDATED = dt.datetime(2024, 1, 25)


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _operation(event_type: Column) -> Column:
    out = None
    for ev, op in OPERATION_OF_EVENT:
        out = (F.when(event_type == ev, op) if out is None else out.when(event_type == ev, op))
    return out


def _null_struct(name: str) -> Column:
    return F.lit(None).cast(ACTION_SCHEMA[name].dataType).alias(name)


def commit_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one row per action, unrefined shape plus ``ingest_seq``.

    One event is one commit of table ``user_id``; a commit has a
    commitInfo row, an add row (not for DELETE) and a remove row
    (rewriting operations from version 3 on).  Built in one scan: the
    three action kinds come from an ``explode``, not a three-way union.
    """
    ev = _read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    # version = position of the event in its table's (ts, event_id) order;
    # numbered per (table, hour) so a table with most events is split
    ev = bucketed_row_number(ev, "user_id", F.date_trunc("hour", F.col("ts")),
                             [F.col("ts"), F.col("event_id")], out="_rn")
    loc = F.concat(F.lit("/lake/db"), (F.col("user_id") % 3).cast("string"),
                   F.lit("/t"), F.col("user_id").cast("string"))
    c = ev.select(
        loc.alias(PATH),
        (F.col("_rn") - 1).cast("bigint").alias(COMMIT_VERSION),
        F.col("ts").cast("timestamp").alias(COMMITTED_ON),
        _operation(F.col("event_type")).alias("op"),
        (F.col("event_id") % 1000 + 1).cast("bigint").alias("size"),
    )
    v = F.col(COMMIT_VERSION)
    kind = F.col("kind")
    c = c.withColumn("kind", F.explode(F.array(F.lit("commitInfo"), F.lit("add"), F.lit("remove"))))
    c = c.where((kind == "commitInfo")
                | ((kind == "add") & (F.col("op") != "DELETE"))
                | ((kind == "remove") & F.col("op").isin(*REMOVING_OPERATIONS) & (v >= 3)))
    millis = F.unix_millis(F.col(COMMITTED_ON))
    commit_info = F.struct(
        v.alias("version"), millis.alias("timestamp"),
        F.lit(None).cast("string").alias("userId"), F.lit(None).cast("string").alias("userName"),
        F.col("op").alias("operation"),
        F.lit(None).cast("map<string,string>").alias("operationParameters"),
        F.when(v > 0, v - 1).alias("readVersion"),
        F.lit("Serializable").alias("isolationLevel"),
        (F.col("op") == "WRITE").alias("isBlindAppend"),
        F.create_map(F.lit("numFiles"), F.when(F.col("op") == "DELETE", "0").otherwise("1"))
        .alias("operationMetrics"),
        F.lit(None).cast("string").alias("engineInfo"), F.lit(None).cast("string").alias("txnId"),
    ).cast(ACTION_SCHEMA["commitInfo"].dataType)
    add_version = F.when(v % 9 == 8, v - 5).otherwise(v)
    add = F.struct(
        F.concat(F.lit("part-"), add_version.cast("string")).alias("path"),
        F.lit(None).cast("map<string,string>").alias("partitionValues"),
        F.col("size").alias("size"), millis.alias("modificationTime"),
        F.lit(True).alias("dataChange"), F.lit(None).cast("string").alias("stats"),
        F.lit(None).cast("map<string,string>").alias("tags"),
    ).cast(ACTION_SCHEMA["add"].dataType)
    remove = F.struct(
        F.concat(F.lit("part-"), (v - 3).cast("string")).alias("path"),
        millis.alias("deletionTimestamp"), F.lit(True).alias("dataChange"),
        F.col("size").alias("size"),
        F.lit(None).cast("map<string,string>").alias("partitionValues"),
    ).cast(ACTION_SCHEMA["remove"].dataType)
    file_name = F.concat(F.col(PATH), F.lit("/_delta_log/"),
                         F.lpad(v.cast("string"), 20, "0"), F.lit(".json"))
    return c.select(
        _null_struct("txn"),
        F.when(kind == "add", add).alias("add"),
        F.when(kind == "remove", remove).alias("remove"),
        _null_struct("metaData"), _null_struct("protocol"), _null_struct("cdc"),
        F.when(kind == "commitInfo", commit_info).alias("commitInfo"),
        file_name.alias(FILE_NAME),
        F.col(PATH),
        path_identity(PATH).alias(PATH_ID),
        v,
        F.lit(FIXTURE_UPDATED_ON).alias(UPDATED_ON),
        F.col(COMMITTED_ON),
        F.to_date(COMMITTED_ON).alias(COMMIT_DATE),
        (F.datediff(F.to_date(COMMITTED_ON), F.lit(INGEST_EPOCH).cast("date")) + 1)
        .cast("bigint").alias(INGEST_SEQ),
    )


_STORED: dict[tuple[str, str], str] = {}


def stored_commit_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 as a stored unrefined table: written once per session and
    source folder below the shared work dir, in the layout of
    ``UnrefinedStore`` (``ingest_seq=<n>/commitShortDate=<d>``, rows
    sorted by table id), then read back with the explicit schema.

    Queries then scan a table, as they do in production, instead of
    re-deriving the fixture in every branch of their plan.
    """
    from commitlens.schemas import UNREFINED_STORED_SCHEMA
    from commitlens.session import scratch_path

    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _STORED.get(key)
    if path is None or not _written(spark, path):
        path = scratch_path(spark, "f1") + "/data"
        # range partitioning on the full sort key: a day or a table with
        # most of the rows is still split over many writer tasks
        (commit_actions(spark, sf_dir)
         .repartitionByRange(INGEST_SEQ, COMMIT_DATE, PATH_ID, COMMIT_VERSION)
         .sortWithinPartitions(INGEST_SEQ, COMMIT_DATE, PATH_ID, COMMIT_VERSION)
         .write.mode("overwrite").partitionBy(INGEST_SEQ, COMMIT_DATE).parquet(path))
        _STORED[key] = path
    return (spark.read.schema(UNREFINED_STORED_SCHEMA).option("basePath", path).parquet(path))


def _written(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def split_target(actions: DataFrame) -> DataFrame:
    """F3 target side: commits before the split day."""
    return actions.where(F.col(COMMITTED_ON) < F.lit(SPLIT_TARGET_BEFORE).cast("timestamp"))


def split_batch(actions: DataFrame) -> DataFrame:
    """F3 batch side (overlaps the target by six days)."""
    return actions.where(F.col(COMMITTED_ON) >= F.lit(SPLIT_BATCH_FROM).cast("timestamp"))


def action_kind() -> Column:
    """Name of the non-null action struct of an unrefined row."""
    return (F.when(F.col("commitInfo").isNotNull(), "commitInfo")
            .when(F.col("add").isNotNull(), "add")
            .when(F.col("remove").isNotNull(), "remove")
            .when(F.col("metaData").isNotNull(), "metaData")
            .when(F.col("protocol").isNotNull(), "protocol")
            .when(F.col("txn").isNotNull(), "txn")
            .when(F.col("cdc").isNotNull(), "cdc"))


def flat_actions(actions: DataFrame) -> DataFrame:
    """Scalar columns of F1 (the shape the oracle SQL uses)."""
    return actions.select(
        PATH, PATH_ID, COMMIT_VERSION, COMMITTED_ON, COMMIT_DATE, FILE_NAME, INGEST_SEQ,
        action_kind().alias("action"),
        F.col("commitInfo.operation").alias("operation"),
        F.col("add.path").alias("add_path"),
        F.col("remove.path").alias("remove_path"),
        F.coalesce(F.col("add.size"), F.col("remove.size")).alias("size"),
    )


def master_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """config table from ``pages`` (plus ``page_id`` for splitting)."""
    pages = _read(spark, sf_dir, "pages").select("page_id", "url")
    pid = F.col("page_id")
    base = F.concat(F.lit("/"), F.regexp_replace(
        F.regexp_replace(F.col("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?#].*", ""))
    loc = F.when(pid % 7 == 0, F.concat(base, F.lit("/**"))).otherwise(base)
    ignore = F.when(pid % 5 == 0, F.lit(True)).when(pid % 11 == 0, F.lit(None)).otherwise(F.lit(False))
    extra = F.create_map(F.lit(WILDCARD_LEVEL), ((pid % 3) - 1).cast("string"))
    return pages.select(pid, loc.alias(PATH), ignore.cast("boolean").alias(IGNORE),
                        extra.alias(EXTRA_CONFIG))


def registry_split(entries: DataFrame, side: str, n: int | None = None) -> DataFrame:
    """F3 split of F2 by page_id: target below 60 %, batch from 40 % of
    the row count ``n`` (one number, fetched by a small job if not given)."""
    n = entries.count() if n is None else n
    if side == "target":
        return entries.where(F.col("page_id") < F.lit(n * 0.6))
    return entries.where(F.col("page_id") >= F.lit(n * 0.4))


def catalog_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(db, table, provider, location) from region x nation."""
    r = _read(spark, sf_dir, "region")
    n = _read(spark, sf_dir, "nation")
    db = F.lower(F.col("r_name"))
    tbl = F.lower(F.col("n_name"))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        db.alias("db"), tbl.alias("table"),
        F.when(F.col("n_nationkey") % 2 == 0, "delta").otherwise("parquet").alias("provider"),
        F.concat(F.lit("/wh/"), db, F.lit("/"), tbl).alias("location"),
    )


EMPTY_DATABASE = "antarctica"   # a database without tables


def resolution_databases(inventory: DataFrame) -> DataFrame:
    """F4 databases and one that has no table."""
    return inventory.select("db").distinct().unionByName(inventory.sparkSession.createDataFrame([(EMPTY_DATABASE,)], "db string"))


def resolution_entries(inventory: DataFrame) -> DataFrame:
    """F4 entries to resolve: database names, ``db.table`` names of delta
    tables, locations of delta tables; databases and names also in other
    spellings (case, backticks, catalog name), and the empty database."""
    delta = inventory.where(F.col("provider") == "delta")
    spellings = F.explode(F.array(F.concat_ws(".", "db", "table"), F.concat_ws(".", F.upper("db"), F.initcap("table")),
                                  F.concat(F.lit("spark_catalog."), F.concat_ws(".", "db", "table")),
                                  F.concat(F.lit("`"), F.col("db"), F.lit("`.`"), F.col("table"), F.lit("`"))))
    return (resolution_databases(inventory).select(F.explode(F.array("db", F.initcap("db"))).alias("entry"))
            .unionByName(delta.select(spellings.alias("entry")))
            .unionByName(delta.select(F.col("location").alias("entry"))))


# --------------------------------------------------------------------------
# DuckDB twins (flat).  Compose as "WITH " + F1_CTE + ", ... SELECT ...".
# --------------------------------------------------------------------------

_OP_CASE = "CASE event_type " + " ".join(
    f"WHEN '{e}' THEN '{o}'" for e, o in OPERATION_OF_EVENT) + " END"
_RM_LIST = ", ".join(f"'{o}'" for o in REMOVING_OPERATIONS)

F1_CTE = f"""
f1_ev AS (
  SELECT event_id, event_type,
         '/lake/db' || CAST(user_id % 3 AS VARCHAR) || '/t' || CAST(user_id AS VARCHAR) AS deltaLocation,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS commitVersion,
         CAST(ts AS TIMESTAMP) AS committedOn
  FROM events
), f1_c AS (
  SELECT deltaLocation, commitVersion, committedOn,
         substring(sha1(deltaLocation), 1, 7) AS deltaLocationIdentifier,
         CAST(committedOn AS DATE) AS commitShortDate,
         deltaLocation || '/_delta_log/' || lpad(CAST(commitVersion AS VARCHAR), 20, '0') || '.json' AS file_name,
         CAST(date_diff('day', DATE '{INGEST_EPOCH}', CAST(committedOn AS DATE)) + 1 AS BIGINT) AS ingest_seq,
         {_OP_CASE} AS op,
         CAST(event_id % 1000 + 1 AS BIGINT) AS fsize
  FROM f1_ev
), f1 AS MATERIALIZED (
  SELECT deltaLocation, deltaLocationIdentifier, commitVersion, committedOn, commitShortDate, file_name, ingest_seq,
         'commitInfo' AS action, op AS operation, CAST(NULL AS VARCHAR) AS add_path,
         CAST(NULL AS VARCHAR) AS remove_path, CAST(NULL AS BIGINT) AS size
  FROM f1_c
  UNION ALL
  SELECT deltaLocation, deltaLocationIdentifier, commitVersion, committedOn, commitShortDate, file_name, ingest_seq,
         'add', CAST(NULL AS VARCHAR),
         'part-' || CAST(CASE WHEN commitVersion % 9 = 8 THEN commitVersion - 5 ELSE commitVersion END AS VARCHAR),
         CAST(NULL AS VARCHAR), fsize
  FROM f1_c WHERE op <> 'DELETE'
  UNION ALL
  SELECT deltaLocation, deltaLocationIdentifier, commitVersion, committedOn, commitShortDate, file_name, ingest_seq,
         'remove', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         'part-' || CAST(commitVersion - 3 AS VARCHAR), fsize
  FROM f1_c WHERE op IN ({_RM_LIST}) AND commitVersion >= 3
), f1_target AS (
  SELECT * FROM f1 WHERE committedOn < TIMESTAMP '{SPLIT_TARGET_BEFORE}'
), f1_batch AS (
  SELECT * FROM f1 WHERE committedOn >= TIMESTAMP '{SPLIT_BATCH_FROM}'
)"""

F2_CTE = r"""
f2 AS (
  SELECT page_id,
         CASE WHEN page_id % 7 = 0
              THEN '/' || regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*', '') || '/**'
              ELSE '/' || regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*', '') END
           AS deltaLocation,
         CASE WHEN page_id % 5 = 0 THEN TRUE WHEN page_id % 11 = 0 THEN NULL ELSE FALSE END AS "ignore",
         CAST((page_id % 3) - 1 AS INTEGER) AS wildCardLevel
  FROM pages
)"""

F4_CTE = """
f4 AS (
  SELECT lower(r_name) AS db, lower(n_name) AS "table",
         CASE WHEN n_nationkey % 2 = 0 THEN 'delta' ELSE 'parquet' END AS provider,
         '/wh/' || lower(r_name) || '/' || lower(n_name) AS location
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""
