"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts
    the lineage at files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_parts(df: DataFrame, *order: Column | str) -> DataFrame:
    """Range-partition by ``order``; ``_part`` ascends with the order."""
    return (df.repartitionByRange(partitions(df.sparkSession), *order)
            .withColumn("_part", F.spark_partition_id()))


def running_start(totals: DataFrame, key: str, value: str, groups: list[str]) -> DataFrame:
    """Sum of ``value`` over the earlier ``key``s of each group; ``totals``
    has one row per partition and group."""
    w = Window.partitionBy(*groups).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_start", F.coalesce(F.sum(value).over(w), F.lit(0)).cast("long")).drop(value)


def numbered(df: DataFrame, order: list[str], groups: list[str] = (), out: str = "row_no") -> DataFrame:
    """0-based row numbers in ``order``, per combination of ``groups``,
    without one task per group.

    The rows are range-partitioned and stored, so that partition numbers
    cannot change; each partition numbers its own rows and adds the row
    count of the earlier partitions.  Only those counts (one per partition
    and group) meet in a window.
    """
    groups = list(groups)
    parts = stored(range_parts(df, *order), "numbered")
    counts = parts.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"))
    starts = running_start(counts.withColumn("_all", F.lit(0)), "_part", "_n", ["_all", *groups]).drop("_all")
    inner = Window.partitionBy("_part", *groups).orderBy(*order)
    rows = parts.withColumn("_rn", F.row_number().over(inner) - 1)
    on = rows["_part"].eqNullSafe(starts["_part"])
    for g in groups:
        on = on & rows[g].eqNullSafe(starts[g])
    keep = [rows[c] for c in df.columns]
    return rows.join(starts, on).select(*keep, (starts["_start"] + rows["_rn"]).cast("long").alias(out))


def running_sum(df: DataFrame, groups: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the earlier rows of the same
    ``groups`` in ``order``, without one task per group: each range
    partition sums its own rows and adds the earlier partitions' totals."""
    parts = stored(range_parts(df, *groups, *order), "summed")
    totals = parts.groupBy("_part", *groups).agg(F.sum(value).alias("_v"))
    starts = running_start(totals, "_part", "_v", groups)
    inner = Window.partitionBy("_part", *groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = parts.withColumn("_in", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    on = rows["_part"] == starts["_part"]
    for g in groups:
        on = on & rows[g].eqNullSafe(starts[g])
    return rows.join(starts, on).select(*[rows[c] for c in df.columns], (starts["_start"] + rows["_in"]).cast("long").alias(out))


U64 = np.uint64
_M1, _M2, _GOLD = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB), U64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (fixed public constants), element-wise."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(U64) + _GOLD
        x = (x ^ (x >> U64(30))) * _M1
        x = (x ^ (x >> U64(27))) * _M2
        return x ^ (x >> U64(31))
