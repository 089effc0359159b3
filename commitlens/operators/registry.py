"""Registry of table locations: config scan, row builder, slicing,
catalog filtering and location resolution (S1, S2, P3, W1, S5, S6)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlens.functions.paths import (
    VALID_LEVELS,
    config_level, has_wildcard_suffix, normalize_location, path_identity,
    strip_wildcard_suffix, table_log_path, wildcard_path,
)
from commitlens.schemas import (
    COMMIT_VERSION, EXTRA_CONFIG, FULL_TABLE_NAME, IGNORE, PATH, PATH_ID,
    UPDATED_ON, WC_PATH, WC_PATH_ID, WILDCARD_LEVEL,
)
from commitlens.session import ensure_work_dir


class ConfigError(ValueError):
    """Raised for config rows or locations that cannot be used."""


def config_scan(master: DataFrame, check_levels: bool = True) -> DataFrame:
    """S1 + F1: rows whose ``ignore`` is not true (NULL is dropped as
    well, as ``<>`` is NULL then), three columns.  With
    ``check_levels`` every row must carry a valid ``wildCardLevel``."""
    rows = master.where(F.col(IGNORE) != F.lit(True)).select(PATH, IGNORE, EXTRA_CONFIG)
    if check_levels:
        missing = rows.where(~F.coalesce(F.map_contains_key(EXTRA_CONFIG, WILDCARD_LEVEL),
                                         F.lit(False)))
        bad = [r[PATH] for r in missing.select(PATH).limit(20).collect()]
        if bad:
            raise ConfigError(f"config rows missing {WILDCARD_LEVEL}: {bad}")
        wrong = rows.where(~F.coalesce(config_level().isin(*VALID_LEVELS), F.lit(False)))
        bad = [r[PATH] for r in wrong.select(PATH).limit(20).collect()]
        if bad:
            raise ConfigError(f"config rows whose {WILDCARD_LEVEL} is not one of {VALID_LEVELS}: {bad}")
    return rows


def split_wildcards(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to expand by listing, with ``**`` stripped;
    rows used as they are).  A NULL location falls in neither."""
    wild = rows.where(has_wildcard_suffix(PATH)).withColumn(PATH, strip_wildcard_suffix(PATH))
    plain = rows.where(~has_wildcard_suffix(PATH))
    return wild, plain


def expand_wildcards(rows: DataFrame, parallelism: int | None = None,
                     strict: bool = False) -> DataFrame:
    """``**`` rows are replaced by the tables found below their
    child directories (listed on executors); other rows pass through.
    Expanded rows keep the parent's ``ignore`` and ``extraConfig``."""
    from commitlens.sources.discovery import discover_tables, list_child_dirs

    wild, plain = split_wildcards(rows)
    children = list_child_dirs(wild, parallelism=parallelism)
    found = discover_tables(children, parallelism=parallelism, strict=strict)
    return found.select(PATH, IGNORE, EXTRA_CONFIG).unionByName(plain.select(PATH, IGNORE, EXTRA_CONFIG))


def registry_rows(table_paths: DataFrame, normalize: bool = True) -> DataFrame:
    """Registry rows from (fullTableName?, deltaLocation, extraConfig).

    The location is normalised before hashing so that a registry id and
    the id derived from a streamed commit-file path agree.  ``updatedOn``
    is the query's start time.
    """
    tp = table_paths
    if FULL_TABLE_NAME not in tp.columns:
        tp = tp.withColumn(FULL_TABLE_NAME, F.lit(None).cast("string"))
    loc = normalize_location(PATH) if normalize else F.col(PATH)
    out = tp.select(loc.alias(PATH), FULL_TABLE_NAME, EXTRA_CONFIG)
    out = out.withColumn(PATH_ID, path_identity(PATH))
    out = out.withColumn(WC_PATH, wildcard_path(F.col(PATH), config_level(EXTRA_CONFIG)))
    out = out.withColumn(WC_PATH_ID, path_identity(WC_PATH))
    return out.select(
        PATH, PATH_ID, WC_PATH, WC_PATH_ID, EXTRA_CONFIG, FULL_TABLE_NAME,
        F.lit(0).cast("bigint").alias(COMMIT_VERSION), F.lit(False).alias(IGNORE),
        F.current_timestamp().alias(UPDATED_ON),
    )


def stream_slice(registry: DataFrame, lower: int = 1, upper: int = 50,
                 use_wildcard_path: bool = True) -> DataFrame:
    """The globs ranked ``lower..upper`` (inclusive) by identifier.

    Ties on the 7-hex identifier are broken by the glob.  Only the first
    ``upper`` rows are ranked: a distributed top-k (the limit *is* the
    slice), so no single task sorts the whole registry.
    """
    if use_wildcard_path:
        g = registry.select(F.col(WC_PATH).alias("path"), F.col(WC_PATH_ID).alias("path_id"))
    else:
        g = registry.select(table_log_path(PATH).alias("path"), F.col(PATH_ID).alias("path_id"))
    top = g.distinct().orderBy("path_id", "path").limit(max(int(upper), 0))
    ranked = top.withColumn("slice_row", F.row_number().over(Window.orderBy("path_id", "path")))
    return ranked.where(F.col("slice_row").between(lower, upper)).select(
        "path", "path_id", F.col("slice_row").cast("bigint").alias("slice_row"))


# ---- S5 catalog filter -------------------------------------------------------

def parse_databases(databases: str | None) -> list[str]:
    """Database list: split on ``, ; :``, trimmed; empty means all."""
    if databases is None or not databases.strip():
        return []
    return [d.strip() for d in re.split(r"[,;:]", databases.strip()) if d.strip()]


def pattern_regex(pattern: str | None) -> str:
    """Catalog table pattern as an anchored, case-insensitive regex:
    ``*`` is any text, ``|`` separates alternatives (as Spark's own
    ``listTables`` reads it)."""
    p = (pattern or "").strip() or "*"
    alts = [a.strip().replace("*", ".*") for a in p.split("|")]
    return "(?i)^(" + "|".join(f"(?:{a})" for a in alts) + ")$"


def catalog_filter(inventory: DataFrame, databases: str | None = None,
                   pattern: str | None = None, provider: str = "delta") -> DataFrame:
    """Tables of the listed databases whose name matches the pattern
    and whose provider is ``provider``; (fullTableName, location)."""
    dbs = parse_databases(databases)
    inv = inventory.where(F.lower("provider") == provider)
    if dbs:
        inv = inv.where(F.col("db").isin(*dbs))
    inv = inv.where(F.col("table").rlike(pattern_regex(pattern)))
    return inv.select(F.concat_ws(".", "db", "table").alias(FULL_TABLE_NAME),
                      F.col("location").alias(PATH))


def inventory_from_catalog(spark, databases: list[str] | None = None) -> DataFrame:
    """Inventory (db, table, provider, location) from the session catalog.

    One ``SHOW TABLE EXTENDED`` command per database (not per table);
    provider and location are parsed from its ``information`` text with
    built-in functions, so the inventory stays a DataFrame.  Temporary
    views are left out.
    """
    from functools import reduce

    from commitlens.schemas import CATALOG_INVENTORY_SCHEMA

    dbs = databases or [d.name for d in spark.catalog.listDatabases()]
    frames = [spark.sql(f"SHOW TABLE EXTENDED IN `{db}` LIKE '*'") for db in dbs]
    if not frames:
        return spark.createDataFrame([], CATALOG_INVENTORY_SCHEMA)
    shown = reduce(lambda a, b: a.unionByName(b), frames).where(~F.col("isTemporary"))
    info = F.col("information")
    return shown.select(
        F.col("namespace").alias("db"), F.col("tableName").alias("table"),
        F.lower(F.regexp_extract(info, r"(?m)^Provider: (\S+)", 1)).alias("provider"),
        F.nullif(F.regexp_extract(info, r"(?m)^Location: (.+)$", 1), F.lit("")).alias("location"),
    )


# ---- S6 location resolution --------------------------------------------------

def databases_from_catalog(spark) -> DataFrame:
    """The session catalog's databases (column ``db``), also those without
    a table."""
    return spark.sql("SHOW DATABASES").select(F.regexp_replace("namespace", "`", "").alias("db"))


def location_lookup(inventory: DataFrame, databases: DataFrame, provider: str = "delta",
                    table_paths: DataFrame | None = None, current_db: str | None = None) -> DataFrame:
    """What an entry can stand for, keyed by (``kind``, ``key``): the tables
    of a database (a row without a location marks the database itself), a
    table path, a table name."""
    tables = inventory.where(F.lower("provider") == provider)
    full = F.concat_ws(".", "db", "table")
    none = F.lit(None).cast("string")

    def rows(df: DataFrame, kind: str, key, name) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), key.alias("key"), name.alias("_name"), F.col("location").alias("_loc"))

    paths = tables.select("location")
    if table_paths is not None:   # path tables found on storage, outside the catalog
        paths = paths.unionByName(table_paths.select("location"))
    out = (rows(tables, "db", F.lower("db"), full)
           .unionByName(rows(databases.select("db", none.alias("location")).distinct(), "db", F.lower("db"), none))
           .unionByName(rows(paths.distinct(), "path", F.col("location"), none))
           .unionByName(rows(tables, "name", F.lower(full), none)))
    if current_db is not None:
        here = tables.where(F.lower("db") == current_db.lower())
        out = out.unionByName(rows(here, "name", F.lower("table"), none))
    return out


def resolve_locations(entries: DataFrame, inventory: DataFrame, provider: str = "delta",
                      raise_unresolved: bool = True,
                      table_paths: DataFrame | None = None,
                      current_db: str | None = None, databases: DataFrame | None = None) -> DataFrame:
    """Each config entry becomes (fullTableName?, deltaLocation).

    Precedence: (a) an entry without ``/`` and ``.`` that names a
    database stands for every table of it -- for none if it is empty;
    (b) an entry equal to a table's location is that path (no name);
    (c) an entry equal to a ``db.table`` name is that table, and one equal
    to a table of ``current_db`` is that table too.  Databases and names
    match in any case, with or without backticks and the session catalog's
    name in front, as identifiers do.  Entries resolved by none raise.
    Other columns of ``entries`` (e.g. ``extraConfig``) are carried.
    ``table_paths`` (column ``location``) adds table paths that are not
    in the catalog (see ``discovery.table_paths``); ``databases`` (column
    ``db``) are all databases, by default those that have tables.

    Every distinct entry is looked up once, by its possible keys, and the
    choice is kept in the shared folder; the tables of a database are then
    one join away.
    """
    carry = [c for c in entries.columns if c != "entry"]
    known = inventory.select("db")
    if databases is not None:
        known = known.unionByName(databases.select("db"))
    lookup = location_lookup(inventory, known.distinct(), provider, table_paths, current_db)
    bare = F.regexp_replace("entry", "`", "")
    ident = F.regexp_replace(F.lower(bare), r"^spark_catalog\.", "")
    is_db = ~F.col("entry").contains("/") & ~bare.contains(".")
    distinct = entries.select("entry").distinct()
    asked = distinct.select("entry", F.explode(F.array(
        F.struct(F.lit(1).alias("rank"), F.lit("db").alias("kind"), F.when(is_db, F.lower(bare)).alias("key")),
        F.struct(F.lit(2).alias("rank"), F.lit("path").alias("kind"), F.col("entry").alias("key")),
        F.struct(F.lit(3).alias("rank"), F.lit("name").alias("kind"), ident.alias("key")))).alias("c")).select("entry", "c.*")
    best = (asked.join(lookup.select("kind", "key").distinct(), ["kind", "key"]).groupBy("entry")
            .agg(F.min(F.struct("rank", "kind", "key")).alias("_b")))
    ensure_work_dir(entries.sparkSession)
    chosen = (distinct.join(best, "entry", "left").select("entry", F.col("_b.kind").alias("kind"), F.col("_b.key").alias("key"))
              .checkpoint(eager=True))
    if raise_unresolved:
        bad = [r["entry"] for r in chosen.where(F.col("kind").isNull()).select("entry").limit(20).collect()]
        if bad:
            raise ConfigError(
                "not a database, table path or table name: " + ", ".join(map(str, bad)))
    found = chosen.join(lookup.where(F.col("_loc").isNotNull()), ["kind", "key"])
    name = F.when(F.col("kind") == "name", F.col("entry")).otherwise(F.col("_name"))
    return entries.join(found, "entry").select("entry", name.alias(FULL_TABLE_NAME), F.col("_loc").alias(PATH), *carry)
