"""Merges without a transactional table format.

* J1/J3 insert-only merge  -> left anti-join of the batch against a
  partition-pruned target on the three-part commit key.
* J2 registry upsert, J4 ledger upsert -> append-only change rows with a
  sequence number plus a "current view" aggregate per key.

The anti-join keys include the commit version, so a table holding a
large share of all commits still hashes across many shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.schemas import (
    COMMIT_DATE, COMMIT_KEY, PATH, PATH_ID, REGISTRY_KEY, UPDATED_ON, WC_PATH,
)

SEQ = "_seq"


def date_bounds(batch: DataFrame, date_col: str = COMMIT_DATE):
    """(min, max) of the batch's partition dates: two values, one small job."""
    row = batch.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi")).first()
    return (row["lo"], row["hi"]) if row is not None else (None, None)


def prune_target(target: DataFrame, lo, hi, date_col: str = COMMIT_DATE) -> DataFrame:
    """F8: restrict the merge target to the batch's date range.

    On a table partitioned by date the literal range is a partition
    filter, which dynamic pruning does not provide for anti-joins.
    """
    if lo is None:
        return target.limit(0)
    return target.where(F.col(date_col).between(F.lit(lo), F.lit(hi)))


def batch_bounds(batch: DataFrame):
    """(min date, max date, (min table id, max table id), rows) of a batch:
    five values from one partially aggregated job."""
    row = batch.agg(F.min(COMMIT_DATE).alias("lo"), F.max(COMMIT_DATE).alias("hi"), F.count(F.lit(1)).alias("n"),
                    F.min(PATH_ID).alias("first"), F.max(PATH_ID).alias("last")).first()
    return row["lo"], row["hi"], (row["first"], row["last"]), row["n"]


# ---- F8 key filter -----------------------------------------------------------

KEY_BITS_MIN, KEY_BITS_MAX = 15, 28   # 2**28 bits: 32 MB of bitmaps at most


def key_bits(rows: int) -> int:
    """Bits of the filter as a power of two: 16 for each row of the batch,
    within the bounds that keep it small enough to send to every task."""
    return min(KEY_BITS_MAX, max(KEY_BITS_MIN, (16 * max(1, rows) - 1).bit_length()))


def _key_place(keys: list[str], bits: int) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << bits) - 1))


def key_filter(batch: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Bitmaps (``_bucket``, ``_bitmap``) over the hashed keys of a batch."""
    place = batch.select(_key_place(keys, bits).alias("p"))
    return place.groupBy(F.bitmap_bucket_number("p").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bitmap"))


def may_match(target: DataFrame, filter_: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """Rows of ``target`` whose key's bit is set: all that match the batch
    and few others.  The filter has at most 2**bits bits, so it is sent to
    the scan's tasks and the rest of the target is never shuffled."""
    place = _key_place(keys, bits)
    t = target.withColumn("_p", place).withColumn("_bucket", F.bitmap_bucket_number("_p"))
    hit = t.join(F.broadcast(filter_), "_bucket").withColumn("_at", F.bitmap_bit_position("_p"))
    byte = F.expr("cast(conv(hex(substring(_bitmap, cast(_at div 8 as int) + 1, 1)), 16, 10) as int)")
    return hit.where(F.getbit(byte.cast("bigint"), (F.col("_at") % 8).cast("int")) == 1).select(*target.columns)


def insert_only_merge(batch: DataFrame, target: DataFrame, keys: list[str] = COMMIT_KEY,
                      prune: bool = False,
                      id_bounds: tuple[str | None, str | None] | None = None,
                      batch_rows: int | None = None) -> DataFrame:
    """Rows of ``batch`` whose commit key is absent from ``target``.

    All rows of a new commit are inserted (no dedup inside the batch);
    NULL keys never match, so they are always inserted.  Returns the
    rows to append; the merged table is ``target`` plus these.

    For a *stored* target: ``prune`` limits it to the batch's date range
    (a partition filter; one small job over the batch), ``id_bounds`` (see
    ``batch_bounds``) to its range of table ids, which reaches Parquet as
    a row-group filter on files sorted by id.  ``batch_rows``, the size of
    the batch, adds the key filter: only target rows that may match one of
    the batch's keys reach the shuffle.
    """
    tgt = target.select(*keys)
    if prune and COMMIT_DATE in keys:
        lo, hi = date_bounds(batch)
        tgt = prune_target(tgt, lo, hi)
    if id_bounds is not None and PATH_ID in keys:
        tgt = tgt.where(F.col(PATH_ID).between(F.lit(id_bounds[0]), F.lit(id_bounds[1])))
    if batch_rows is not None:
        bits = key_bits(batch_rows)
        tgt = may_match(tgt, key_filter(batch, keys, bits), keys, bits)
    cond = [batch[k] == tgt[k] for k in keys]
    return batch.join(tgt, on=cond, how="left_anti")


def batch_partitions(batch: DataFrame) -> DataFrame:
    """A1: distinct table ids and distinct commit dates of a batch, as
    rows (partition_column, value) -- one pass, map-side partial agg."""
    ids = batch.select(F.lit(PATH_ID).alias("partition_column"),
                       F.col(PATH_ID).alias("value"))
    dates = batch.select(F.lit(COMMIT_DATE).alias("partition_column"),
                         F.col(COMMIT_DATE).cast("string").alias("value"))
    return ids.unionByName(dates).distinct()


# ---- J2 registry -----------------------------------------------------------

def registry_changes(rows: DataFrame, seq: int | Column) -> DataFrame:
    """Change rows of one upsert call: the source, de-duplicated on the
    registry key (deterministically: smallest location, then glob)."""
    keyed = rows.groupBy(*REGISTRY_KEY).agg(
        F.min_by(F.struct(*[c for c in rows.columns if c not in REGISTRY_KEY]),
                 F.struct(F.col(PATH), F.col(WC_PATH), F.col(UPDATED_ON))).alias("r"))
    return keyed.select(*REGISTRY_KEY, "r.*").withColumn(SEQ, F.lit(seq) if isinstance(seq, int) else seq)


def registry_current(changes: DataFrame, truncated_before: int | None = None) -> DataFrame:
    """J2 current view: per key, the attributes of the first insert and
    the ``updatedOn`` of the latest change.  ``truncated_before`` drops
    the change rows of earlier sequences (the ``truncate`` flag)."""
    if truncated_before is not None:
        changes = changes.where(F.col(SEQ) >= truncated_before)
    attrs = [c for c in changes.columns if c not in REGISTRY_KEY + [UPDATED_ON, SEQ]]
    order = F.struct(F.col(SEQ), F.col(PATH), F.col(WC_PATH))
    cur = changes.groupBy(*REGISTRY_KEY).agg(
        F.min_by(F.struct(*attrs), order).alias("first"),
        F.max_by(F.col(UPDATED_ON), F.struct(F.col(SEQ), F.col(UPDATED_ON))).alias(UPDATED_ON),
    )
    return cur.select(*REGISTRY_KEY, "first.*", UPDATED_ON)


def registry_upsert(target: DataFrame, updates: DataFrame) -> DataFrame:
    """J2 on two frames: matched keys take the update's ``updatedOn``
    only; unmatched update rows are inserted whole."""
    cols = target.columns
    changes = (registry_changes(target.select(*cols), 0)
               .unionByName(registry_changes(updates.select(*cols), 1)))
    return registry_current(changes).select(*cols)


# ---- J4 ledger -------------------------------------------------------------

def ledger_current(changes: DataFrame, seq_col: str = SEQ) -> DataFrame:
    """J4 current view: per ``tableName`` the whole latest change row."""
    latest = changes.groupBy("tableName").agg(
        F.max_by(F.struct("latestVersion", UPDATED_ON), F.col(seq_col)).alias("r"))
    return latest.select("tableName", "r.*")


def high_water_marks(ledger: DataFrame, names: DataFrame) -> DataFrame:
    """A4 for many names: the ledger's ``latestVersion``, 0 when absent."""
    cur = ledger_current(ledger) if SEQ in ledger.columns else ledger
    return (names.select("tableName").distinct()
            .join(cur.select("tableName", "latestVersion"), "tableName", "left")
            .select("tableName", F.coalesce("latestVersion", F.lit(0).cast("bigint"))
                    .alias("latestVersion")))


def high_water_mark(ledger: DataFrame, table_name: str) -> int:
    """A4: one table's mark; 0 only when the row is missing (errors
    propagate instead of restarting from 0)."""
    cur = ledger_current(ledger) if SEQ in ledger.columns else ledger
    row = (cur.where(F.col("tableName") == table_name)
           .agg(F.max("latestVersion").alias("v")).first())
    return int(row["v"]) if row is not None and row["v"] is not None else 0
