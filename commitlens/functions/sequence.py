"""Per-key sequence numbers and running sums without one task per key.

``row_number() over (partition by key order by ...)`` puts every row of a
key into one task; a key holding a third of all rows then sorts a third
of the data alone.  Here a coarse, order-preserving bucket (e.g. the hour
of a timestamp) splits each key: rows are numbered inside (key, bucket)
partitions, and each bucket adds the row count of the key's earlier
buckets -- a window over bucket *totals*, which are few per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_row_number(df: DataFrame, key: str, bucket: Column, order: list[Column | str],
                        out: str = "row_number", descending: bool = False) -> DataFrame:
    """``row_number()`` per ``key`` in ``order`` (1-based, bigint).
    ``descending``: ``order`` runs downwards, and so do the buckets.

    ``bucket`` must be monotone in ``order`` (bucket(a) < bucket(b)
    implies a before b), e.g. ``date_trunc('hour', ts)`` for order
    ``(ts, id)``.
    """
    d = df.withColumn("_sq_bkt", bucket)
    counts = d.groupBy(key, "_sq_bkt").agg(F.count(F.lit(1)).alias("_sq_n"))
    at = F.col("_sq_bkt")
    before = Window.partitionBy(key).orderBy(at.desc() if descending else at).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_sq_bkt", F.coalesce(F.sum("_sq_n").over(before), F.lit(0)).alias("_sq_off"))
    inner = Window.partitionBy(key, "_sq_bkt").orderBy(*order)
    numbered = d.withColumn("_sq_rn", F.row_number().over(inner))
    return (numbered.join(offsets, [key, "_sq_bkt"])
            .withColumn(out, (F.col("_sq_off") + F.col("_sq_rn")).cast("bigint"))
            .drop("_sq_bkt", "_sq_rn", "_sq_off"))
