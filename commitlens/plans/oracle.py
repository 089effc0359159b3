"""DuckDB oracle SQL for each registered query (same names, columns, types).

The snapshot oracles are written from the definition -- an add is live at
every later version before its file's first removal --, with each add
repeated for every later version, so they check the interval form of
``commitlens.operators.snapshots`` rather than restate it.
"""

from __future__ import annotations

from commitlens.plans.fixtures import (
    EMPTY_DATABASE, F1_CTE, F2_CTE, F4_CTE, REGISTRY_BATCH_UPDATED, REGISTRY_TARGET_UPDATED,
)
from commitlens.plans.queries import CATALOG_DATABASES, CATALOG_PATTERN, SLICE_LOWER, SLICE_UPPER
from commitlens.operators.registry import parse_databases

FLAT = ("deltaLocation, deltaLocationIdentifier, commitVersion, committedOn, commitShortDate, "
        "file_name, action, operation, add_path, remove_path, size")

REFINED = ("commitVersion, committedOn, file_name, deltaLocation, deltaLocationIdentifier, "
           "commitShortDate, operation, "
           "CASE WHEN commitVersion > 0 THEN commitVersion - 1 END AS readVersion, "
           "'Serializable' AS isolationLevel, operation = 'WRITE' AS isBlindAppend")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _snapshot_ctes(name: str, actions: str, carried: str | None = None) -> str:
    """CTEs ``{name}_ar .. {name}`` for the snapshot of ``actions`` (flat
    F1 rows).  ``carried`` optionally adds snapshot rows as adds."""
    carry = ""
    if carried:
        carry = f"""
  UNION ALL
  SELECT deltaLocationIdentifier, data_path, commitVersion, committedOn, commitShortDate,
         add_path, add_size, CAST(NULL AS VARCHAR) AS remove_path FROM {carried}"""
    return f"""
{name}_dadds AS (
  SELECT * FROM (
    SELECT *, rank() OVER (PARTITION BY deltaLocationIdentifier, add_path
                           ORDER BY commitVersion DESC NULLS LAST) AS rk
    FROM {actions} WHERE action = 'add') WHERE rk = 1
), {name}_ar AS MATERIALIZED (
  SELECT deltaLocationIdentifier, deltaLocation AS data_path, commitVersion, committedOn, commitShortDate,
         add_path, size AS add_size, CAST(NULL AS VARCHAR) AS remove_path FROM {name}_dadds
  UNION ALL
  SELECT deltaLocationIdentifier, deltaLocation, commitVersion, committedOn, commitShortDate,
         CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), remove_path FROM {actions} WHERE action = 'remove'{carry}
), {name}_cv AS (
  SELECT DISTINCT deltaLocationIdentifier, commitVersion, committedOn, commitShortDate FROM {name}_ar
), {name}_gone AS MATERIALIZED (
  SELECT deltaLocationIdentifier, remove_path, min(commitVersion) AS removedAt
  FROM {name}_ar WHERE remove_path IS NOT NULL GROUP BY 1, 2
), {name} AS (
  SELECT ar.deltaLocationIdentifier, ar.data_path, cv.commitVersion, cv.committedOn, cv.commitShortDate,
         ar.add_path, ar.add_size
  FROM {name}_ar ar
  JOIN {name}_cv cv ON ar.deltaLocationIdentifier = cv.deltaLocationIdentifier AND ar.commitVersion <= cv.commitVersion
  LEFT JOIN {name}_gone g ON g.deltaLocationIdentifier = ar.deltaLocationIdentifier AND g.remove_path = ar.add_path
  WHERE ar.add_path IS NOT NULL AND (g.removedAt IS NULL OR g.removedAt > cv.commitVersion)
)"""


_NEW_ROWS = """
f1_known AS MATERIALIZED (SELECT DISTINCT deltaLocationIdentifier, commitShortDate, commitVersion FROM f1_target),
f1_new AS MATERIALIZED (
  SELECT b.* FROM f1_batch b ANTI JOIN f1_known USING (deltaLocationIdentifier, commitShortDate, commitVersion)
)"""

_REFINED_TARGET = f"""
ref_target AS (SELECT {REFINED} FROM f1_target WHERE action = 'commitInfo' AND operation IS NOT NULL)"""

# -- F2 helpers ---------------------------------------------------------------

_NORM = "regexp_replace(regexp_replace({x}, '^file:/+', '/'), '(.)/+$', '\\1')"


def _norm(x: str) -> str:
    return _NORM.format(x=x)


def _wc(p: str, lv: str) -> str:
    parts = f"string_split(regexp_replace({p}, '/+$', ''), '/')"
    n = f"CASE WHEN {lv} = -1 THEN len({parts}) ELSE greatest(len({parts}) - 1 - {lv}, 0) END"
    stars = f"CASE WHEN {lv} = -1 THEN []::VARCHAR[] WHEN {lv} = 0 THEN ['*'] ELSE ['*', '*'] END"
    return (f"CASE WHEN {p} IS NULL OR {lv} IS NULL THEN NULL ELSE "
            f"array_to_string(list_concat({parts}[1:{n}], {stars}), '/') || '/_delta_log/*.json' END")


_PLAIN = """
f2_plain AS (SELECT * REPLACE (CASE WHEN right(deltaLocation, 2) = '**' THEN left(deltaLocation, len(deltaLocation) - 2)
                             ELSE deltaLocation END AS deltaLocation) FROM f2)"""

_REG = f"""
reg AS (
  SELECT page_id, {_norm('deltaLocation')} AS deltaLocation, wildCardLevel FROM f2_plain
), reg2 AS (
  SELECT page_id, deltaLocation, substring(sha1(deltaLocation), 1, 7) AS deltaLocationIdentifier,
         {_wc('deltaLocation', 'wildCardLevel')} AS wcPath, wildCardLevel FROM reg
), reg3 AS (
  SELECT *, substring(sha1(wcPath), 1, 7) AS wcPathIdentifier FROM reg2
)"""

_LEDGER_ALL = """
ledger AS (
  SELECT deltaLocation AS tableName, commitVersion AS latestVersion, committedOn AS updatedOn,
         commitVersion AS seq
  FROM f1 WHERE action = 'commitInfo'
)"""


def _catalog_where() -> str:
    dbs = ", ".join(f"'{d}'" for d in parse_databases(CATALOG_DATABASES))
    alts = "|".join(f"(?:{a.strip().replace('*', '.*')})" for a in CATALOG_PATTERN.split("|"))
    return f"provider = 'delta' AND db IN ({dbs}) AND regexp_full_match(\"table\", '{alts}', 'i')"


_ENTRIES = f"""
dbs AS (SELECT DISTINCT db FROM f4 UNION ALL SELECT '{EMPTY_DATABASE}'),
delta AS (SELECT * FROM f4 WHERE provider = 'delta'),
f4_entries AS (
  SELECT db AS entry, 'db' AS kind, db AS key FROM dbs
  UNION ALL SELECT array_to_string(list_transform(string_split(db, ' '), lambda w: upper(left(w, 1)) || substring(w, 2)), ' '), 'db', db FROM dbs
  UNION ALL SELECT location, 'path', location FROM delta
  UNION ALL SELECT db || '.' || "table", 'name', location FROM delta
  UNION ALL SELECT upper(db) || '.' || array_to_string(list_transform(string_split("table", ' '), lambda w: upper(left(w, 1)) || substring(w, 2)), ' '),
                   'name', location FROM delta
  UNION ALL SELECT 'spark_catalog.' || db || '.' || "table", 'name', location FROM delta
  UNION ALL SELECT '`' || db || '`.`' || "table" || '`', 'name', location FROM delta
)"""


ORACLE: dict[str, str] = {
    "flatten_commit_info": _with(F1_CTE) +
        f"SELECT {REFINED} FROM f1 WHERE action = 'commitInfo' AND operation IS NOT NULL",
    "commit_enrich": _with(F1_CTE) +
        "SELECT file_name, deltaLocation, deltaLocationIdentifier, commitVersion, committedOn, "
        "commitShortDate FROM f1",
    "table_log_path": _with(F1_CTE) +
        "SELECT DISTINCT deltaLocation || '/_delta_log/*.json' AS log_path, deltaLocationIdentifier FROM f1",
    "batch_partitions": _with(F1_CTE) +
        "SELECT DISTINCT 'deltaLocationIdentifier' AS partition_column, deltaLocationIdentifier AS value "
        "FROM f1_batch UNION SELECT DISTINCT 'commitShortDate', CAST(commitShortDate AS VARCHAR) FROM f1_batch",
    "live_files": _with(F1_CTE, _snapshot_ctes("snap", "f1")) + "SELECT * FROM snap",
    "live_files_incremental": _with(
        F1_CTE, _NEW_ROWS, _snapshot_ctes("prev", "f1_target"),
        """
prev_max AS (SELECT deltaLocationIdentifier, max(commitVersion) AS commitVersion FROM prev GROUP BY 1),
prev_carry AS (SELECT p.* FROM prev p JOIN prev_max m
               ON p.deltaLocationIdentifier = m.deltaLocationIdentifier AND p.commitVersion = m.commitVersion)""",
        _snapshot_ctes("nxt", "f1_new", carried="prev_carry")) +
        "SELECT * FROM nxt n WHERE NOT EXISTS (SELECT 1 FROM prev_max m WHERE "
        "m.deltaLocationIdentifier = n.deltaLocationIdentifier AND m.commitVersion = n.commitVersion)",
    "live_file_metrics": _with(F1_CTE, _snapshot_ctes("snap", "f1")) +
        "SELECT deltaLocationIdentifier, commitVersion, committedOn, commitShortDate, "
        "CAST(count(*) AS BIGINT) AS live_files, CAST(sum(coalesce(add_size, 0)) AS BIGINT) AS live_bytes "
        "FROM snap GROUP BY 1, 2, 3, 4",
    "live_files_state": _with(F1_CTE, _snapshot_ctes("snap", "f1")) +
        """, mx AS (SELECT deltaLocationIdentifier, max(commitVersion) AS commitVersion FROM snap GROUP BY 1)
SELECT s.* FROM snap s JOIN mx ON s.deltaLocationIdentifier = mx.deltaLocationIdentifier
  AND s.commitVersion = mx.commitVersion""",
    "dedup_adds": _with(F1_CTE, _snapshot_ctes("snap", "f1")) +
        "SELECT deltaLocationIdentifier, deltaLocation AS data_path, commitVersion, add_path, "
        "size AS add_size FROM snap_dadds",
    "replay_file_intervals": _with(F1_CTE) + """, ev AS (
  SELECT deltaLocationIdentifier, deltaLocation AS data_path, add_path AS file, commitVersion, 0 AS ord,
         size AS add_size FROM f1 WHERE action = 'add'
  UNION ALL
  SELECT deltaLocationIdentifier, deltaLocation, remove_path, commitVersion, 1, NULL FROM f1 WHERE action = 'remove'
), l AS (
  SELECT *, lead(commitVersion) OVER (PARTITION BY deltaLocationIdentifier, file ORDER BY commitVersion, ord) AS nxt
  FROM ev
)
SELECT deltaLocationIdentifier, data_path, file, commitVersion AS start, nxt AS "end", add_size
FROM l WHERE ord = 0 AND (nxt IS NULL OR nxt > commitVersion)""",
    "insert_only_merge": _with(F1_CTE, _NEW_ROWS) + f"SELECT {FLAT} FROM f1_new",
    "refine_commits": _with(F1_CTE, _REFINED_TARGET) +
        f"""SELECT * FROM ref_target
UNION ALL
SELECT * FROM (SELECT {REFINED} FROM f1_batch WHERE action = 'commitInfo' AND operation IS NOT NULL) b
WHERE NOT EXISTS (SELECT 1 FROM ref_target t WHERE t.deltaLocationIdentifier = b.deltaLocationIdentifier
  AND t.commitShortDate = b.commitShortDate AND t.commitVersion = b.commitVersion)""",
    "changes_since": _with(F1_CTE) +
        f"SELECT {FLAT} FROM f1 WHERE ingest_seq > (SELECT max(ingest_seq) FROM f1_target)",
    "incremental_refine": _with(F1_CTE, _REFINED_TARGET) +
        f"""SELECT * FROM (SELECT {REFINED} FROM f1
  WHERE ingest_seq > (SELECT max(ingest_seq) FROM f1_target)
    AND action = 'commitInfo' AND operation IS NOT NULL) b
WHERE NOT EXISTS (SELECT 1 FROM ref_target t WHERE t.deltaLocationIdentifier = b.deltaLocationIdentifier
  AND t.commitShortDate = b.commitShortDate AND t.commitVersion = b.commitVersion)""",
    "latest_version": _with(F1_CTE) +
        "SELECT CAST(coalesce(max(ingest_seq), 0) AS BIGINT) AS latest_version FROM f1",
    "high_water_mark": _with(F1_CTE) +
        """SELECT deltaLocation AS tableName, max(commitVersion) AS latestVersion FROM f1 WHERE action = 'commitInfo' GROUP BY 1
UNION ALL SELECT DISTINCT deltaLocation || '_new', CAST(0 AS BIGINT) FROM f1""",
    "land_batches": _with(F1_CTE) + f"SELECT {FLAT} FROM f1",
    "ledger_upsert": _with(F1_CTE, _LEDGER_ALL) +
        """SELECT tableName, latestVersion, updatedOn FROM (
  SELECT *, row_number() OVER (PARTITION BY tableName ORDER BY seq DESC) AS rn FROM ledger) WHERE rn = 1""",
    "config_scan": _with(F2_CTE) +
        "SELECT deltaLocation, \"ignore\", wildCardLevel FROM f2 WHERE \"ignore\" <> TRUE",
    "expand_wildcards": _with(F2_CTE) +
        """SELECT CASE WHEN right(deltaLocation, 2) = '**' THEN substring(deltaLocation, 1, length(deltaLocation) - 2)
            ELSE deltaLocation END AS deltaLocation,
       "ignore", wildCardLevel, right(deltaLocation, 2) = '**' AS expand
FROM f2 WHERE "ignore" <> TRUE""",
    "path_identity": _with(F2_CTE) +
        f"""SELECT deltaLocation, {_norm('deltaLocation')} AS normalizedLocation,
       substring(sha1({_norm('deltaLocation')}), 1, 7) AS deltaLocationIdentifier
FROM (SELECT DISTINCT deltaLocation FROM f2)""",
    "wildcard_path": _with(F2_CTE, _PLAIN) +
        f"SELECT deltaLocation, wildCardLevel, {_wc('deltaLocation', 'wildCardLevel')} AS wcPath FROM f2_plain",
    "registry_rows": _with(F2_CTE, _PLAIN, _REG) +
        """SELECT deltaLocation, deltaLocationIdentifier, wcPath, wcPathIdentifier, wildCardLevel,
       CAST(NULL AS VARCHAR) AS fullTableName, CAST(0 AS BIGINT) AS commitVersion, FALSE AS "ignore"
FROM reg3""",
    "consolidate_globs": _with(F2_CTE, _PLAIN, _REG) +
        """, g AS (SELECT DISTINCT wcPath, wcPathIdentifier, split_part(wcPath, '*', 1) AS pre FROM reg3)
SELECT b.wcPath, b.wcPathIdentifier,
       CAST(row_number() OVER (ORDER BY b.wcPath DESC, b.wcPathIdentifier DESC) AS BIGINT) AS rank FROM g b
WHERE NOT EXISTS (
  SELECT 1 FROM g a
  WHERE (a.wcPath < b.wcPath OR (a.wcPath = b.wcPath AND a.wcPathIdentifier < b.wcPathIdentifier))
    AND (contains(a.pre, b.pre) OR contains(b.pre, a.pre)))""",
    "stream_slice": _with(F2_CTE, _PLAIN, _REG) +
        f"""SELECT path, path_id, slice_row FROM (
  SELECT path, path_id, CAST(row_number() OVER (ORDER BY path_id, path) AS BIGINT) AS slice_row
  FROM (SELECT DISTINCT wcPath AS path, wcPathIdentifier AS path_id FROM reg3))
WHERE slice_row BETWEEN {SLICE_LOWER} AND {SLICE_UPPER}""",
    "registry_upsert": _with(F2_CTE, _PLAIN, _REG) +
        f""", n AS (SELECT count(*) AS n FROM f2_plain),
u AS (
  SELECT deltaLocation, deltaLocationIdentifier, wcPath, wcPathIdentifier, wildCardLevel,
         TIMESTAMP '{REGISTRY_TARGET_UPDATED}' AS updatedOn, 0 AS seq
  FROM reg3 WHERE page_id < 0.6 * (SELECT n FROM n)
  UNION ALL
  SELECT deltaLocation, deltaLocationIdentifier, wcPath, wcPathIdentifier, wildCardLevel,
         TIMESTAMP '{REGISTRY_BATCH_UPDATED}', 1
  FROM reg3 WHERE page_id >= 0.4 * (SELECT n FROM n)
), firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY deltaLocationIdentifier, wcPathIdentifier
                                               ORDER BY seq, deltaLocation, wcPath) AS rn FROM u) WHERE rn = 1
), lasts AS (
  SELECT deltaLocationIdentifier, wcPathIdentifier, max(updatedOn) AS updatedOn FROM u GROUP BY 1, 2
)
SELECT f.deltaLocation, f.deltaLocationIdentifier, f.wcPath, f.wcPathIdentifier, f.wildCardLevel, l.updatedOn
FROM firsts f JOIN lasts l USING (deltaLocationIdentifier, wcPathIdentifier)""",
    "catalog_filter": _with(F4_CTE) +
        f"SELECT db || '.' || \"table\" AS fullTableName, location AS deltaLocation FROM f4 WHERE {_catalog_where()}",
    "resolve_locations": _with(F4_CTE, _ENTRIES) +
        """SELECT e.entry, d.db || '.' || d."table" AS fullTableName, d.location AS deltaLocation
FROM f4_entries e JOIN delta d ON e.kind = 'db' AND d.db = e.key
UNION ALL
SELECT entry, CASE WHEN kind = 'name' THEN entry END, key FROM f4_entries WHERE kind <> 'db'""",
}


ORACLE["live_file_intervals"] = ORACLE["replay_file_intervals"]
ORACLE["live_files_continued"] = ORACLE["live_files_incremental"]
ORACLE["registry_scan"] = ORACLE["registry_upsert"]
ORACLE["bootstrap_tables"] = _with(F2_CTE, _PLAIN, _REG) + """, n AS (SELECT count(*) AS n FROM f2_plain)
SELECT 'delta_location_details' AS name, CAST(count(DISTINCT deltaLocationIdentifier || ' ' || wcPathIdentifier) AS BIGINT) AS n_rows,
       CAST(count(DISTINCT deltaLocationIdentifier || ' ' || wcPathIdentifier) AS BIGINT) AS n_keys FROM reg3
UNION ALL SELECT 'master', CAST(count(*) AS BIGINT), CAST(count(DISTINCT deltaLocation) AS BIGINT) FROM f2
UNION ALL SELECT 'processed_log', 0, 0
UNION ALL SELECT 'unrefined_metrics', 0, 0"""


def _stream_oracle() -> dict[str, str]:
    from commitlens.plans.stream_queries import STREAM_ORACLE

    return {k: _with(F1_CTE) + v for k, v in STREAM_ORACLE.items()}


ORACLE.update(_stream_oracle())
ORACLE["snapshot_stream"] = f"SELECT data_path, file, start, \"end\", add_size FROM ({ORACLE['replay_file_intervals']})"
ORACLE["expand_wildcards_listed"] = _with(F2_CTE) + """, keep AS (SELECT * FROM f2 WHERE "ignore" <> TRUE),
wild AS (SELECT left(deltaLocation, len(deltaLocation) - 2) AS base, * FROM keep WHERE right(deltaLocation, 2) = '**'),
made AS (SELECT DISTINCT base || 't' || page_id AS path FROM wild)
SELECT m.path AS deltaLocation, w."ignore", w.wildCardLevel FROM wild w JOIN made m ON starts_with(m.path, w.base)
UNION ALL SELECT deltaLocation, "ignore", wildCardLevel FROM keep WHERE right(deltaLocation, 2) <> '**'"""
