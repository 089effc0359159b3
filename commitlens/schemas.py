"""Explicit schemas and column names of every table (never inferred).

The action schema follows the public Delta Lake transaction-log
protocol (Armbrust et al., VLDB 2020): one nullable struct per action
kind, exactly one of them non-null in each JSON line.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- column names ---------------------------------------------------------
PATH = "deltaLocation"
PATH_ID = "deltaLocationIdentifier"
WC_PATH = "wcPath"
WC_PATH_ID = "wcPathIdentifier"
EXTRA_CONFIG = "extraConfig"
WILDCARD_LEVEL = "wildCardLevel"
IGNORE = "ignore"
FULL_TABLE_NAME = "fullTableName"
COMMIT_VERSION = "commitVersion"
UPDATED_ON = "updatedOn"
COMMITTED_ON = "committedOn"
COMMIT_DATE = "commitShortDate"
FILE_NAME = "file_name"
INGEST_SEQ = "ingest_seq"

# The three-part commit key of unrefined and refined tables.
COMMIT_KEY = [PATH_ID, COMMIT_DATE, COMMIT_VERSION]
# Registry key.
REGISTRY_KEY = [PATH_ID, WC_PATH_ID]

_STR_MAP = T.MapType(T.StringType(), T.StringType())


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


COMMIT_INFO = _s(
    ("version", T.LongType()),
    ("timestamp", T.LongType()),
    ("userId", T.StringType()),
    ("userName", T.StringType()),
    ("operation", T.StringType()),
    ("operationParameters", _STR_MAP),
    ("readVersion", T.LongType()),
    ("isolationLevel", T.StringType()),
    ("isBlindAppend", T.BooleanType()),
    ("operationMetrics", _STR_MAP),
    ("engineInfo", T.StringType()),
    ("txnId", T.StringType()),
)

ADD_FILE = _s(
    ("path", T.StringType()),
    ("partitionValues", _STR_MAP),
    ("size", T.LongType()),
    ("modificationTime", T.LongType()),
    ("dataChange", T.BooleanType()),
    ("stats", T.StringType()),
    ("tags", _STR_MAP),
)

REMOVE_FILE = _s(
    ("path", T.StringType()),
    ("deletionTimestamp", T.LongType()),
    ("dataChange", T.BooleanType()),
    ("size", T.LongType()),
    ("partitionValues", _STR_MAP),
)

METADATA = _s(
    ("id", T.StringType()),
    ("name", T.StringType()),
    ("description", T.StringType()),
    ("format", _s(("provider", T.StringType()), ("options", _STR_MAP))),
    ("schemaString", T.StringType()),
    ("partitionColumns", T.ArrayType(T.StringType())),
    ("configuration", _STR_MAP),
    ("createdTime", T.LongType()),
)

PROTOCOL = _s(("minReaderVersion", T.IntegerType()), ("minWriterVersion", T.IntegerType()))
TXN = _s(("appId", T.StringType()), ("version", T.LongType()), ("lastUpdated", T.LongType()))
CDC = _s(("path", T.StringType()), ("partitionValues", _STR_MAP), ("size", T.LongType()))

# One JSON line of a commit file.
ACTION_SCHEMA = _s(
    ("txn", TXN),
    ("add", ADD_FILE),
    ("remove", REMOVE_FILE),
    ("metaData", METADATA),
    ("protocol", PROTOCOL),
    ("cdc", CDC),
    ("commitInfo", COMMIT_INFO),
)

ACTION_FIELDS = [f.name for f in ACTION_SCHEMA.fields]

# Columns added to each action when it lands in unrefined.
COMMIT_COLUMNS = [
    (FILE_NAME, T.StringType()),
    (PATH, T.StringType()),
    (PATH_ID, T.StringType()),
    (COMMIT_VERSION, T.LongType()),
    (UPDATED_ON, T.TimestampType()),
    (COMMITTED_ON, T.TimestampType()),
    (COMMIT_DATE, T.DateType()),
]

UNREFINED_SCHEMA = T.StructType(
    list(ACTION_SCHEMA.fields)
    + [T.StructField(n, t, True) for n, t in COMMIT_COLUMNS]
)

# The fixture's stored form: unrefined rows with an ingest sequence.
UNREFINED_STORED_SCHEMA = T.StructType(
    list(UNREFINED_SCHEMA.fields) + [T.StructField(INGEST_SEQ, T.LongType(), True)]
)

# Layout of the landed unrefined table: one folder per micro-batch, then the date.
LANDING_COLUMNS = ["mode", "stream", "run", "batch"]
LANDED_SCHEMA = T.StructType(
    [f for f in UNREFINED_SCHEMA.fields if f.name != COMMIT_DATE]
    + [T.StructField("mode", T.StringType()), T.StructField("stream", T.StringType()),
       T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()),
       T.StructField(COMMIT_DATE, T.DateType())]
)

# Notice of a landed batch (one JSON file each).
NOTICE_SCHEMA = _s(
    ("mode", T.StringType()), ("stream", T.StringType()), ("run", T.StringType()), ("batch", T.LongType()),
    ("rows_read", T.LongType()), ("rows_landed", T.LongType()), ("rows_known", T.LongType()),
    ("min_version", T.LongType()), ("max_version", T.LongType()),
)

MASTER_SCHEMA = _s(
    (PATH, T.StringType()),
    (IGNORE, T.BooleanType()),
    (EXTRA_CONFIG, _STR_MAP),
)

REGISTRY_SCHEMA = _s(
    (PATH, T.StringType()),
    (PATH_ID, T.StringType()),
    (WC_PATH, T.StringType()),
    (WC_PATH_ID, T.StringType()),
    (EXTRA_CONFIG, _STR_MAP),
    (FULL_TABLE_NAME, T.StringType()),
    (COMMIT_VERSION, T.LongType()),
    (IGNORE, T.BooleanType()),
    (UPDATED_ON, T.TimestampType()),
)

LEDGER_SCHEMA = _s(
    ("tableName", T.StringType()),
    ("latestVersion", T.LongType()),
    (UPDATED_ON, T.TimestampType()),
)

CATALOG_INVENTORY_SCHEMA = _s(
    ("db", T.StringType()),
    ("table", T.StringType()),
    ("provider", T.StringType()),
    ("location", T.StringType()),
)
