"""Sharding by a Feistel permutation of the global row numbers.

Rows are numbered in ascending id order (``common.numbered``: per-range
counts, no global window) and the number ``r`` in ``[0, N)`` is permuted by
a balanced Feistel network over the next even power of two; results
outside ``[0, N)`` are fed back until they fall inside (cycle walking), so
the map is a bijection of ``[0, N)``.  Permuted position ``p`` goes to
shard ``p mod S``, slot ``p div S``: shard sizes differ by one row at most,
slots are gapless, and both can be computed -- in either direction -- from
the row number, N and the key alone.

Defined cases: null ids sort first; null texts have size 1 and a null
CRC; repeated ids keep one row each, ties in unspecified but fixed order of
(id, size, crc); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import U64, mix64, numbered, table

ROUNDS = 6


def _halves(n: int) -> int:
    return max(1, (max(1, n - 1).bit_length() + 1) // 2)


def feistel(x: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Permute ``x`` (values in ``[0, n)``) within ``[0, n)``."""
    h = _halves(n)
    mask, bits = U64((1 << h) - 1), U64(h)
    keys = mix64(np.arange(ROUNDS, dtype=U64) + U64(seed * 1000003 & (1 << 63) - 1))
    out = np.asarray(x).astype(U64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> bits, out[walk] & mask
        for k in keys[::-1] if inverse else keys:
            if inverse:
                left, right = right ^ (mix64(left ^ k) & mask), left
            else:
                left, right = right, left ^ (mix64(right ^ k) & mask)
        out[walk] = left << bits | right
        walk = walk[out[walk] >= U64(n)]
    return out.astype(np.int64)


def shard_rows(df: DataFrame, shards: int = 8, seed: int = 0, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, row_no, shard, slot`` of every row."""
    rows = numbered(df.select(F.col(id_col).alias("doc_id"),
                              (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
                              F.crc32(F.col(text_col).cast("binary")).alias("text_crc32")),
                    ["doc_id", "size", "text_crc32"])
    total = rows.count()

    @F.pandas_udf("long")
    def place(row_no: pd.Series) -> pd.Series:
        return pd.Series(feistel(row_no.to_numpy(), total, seed))

    at = place("row_no")
    return (rows.withColumn("_at", at)
            .withColumn("shard", F.expr(f"cast(_at % {shards} as int)"))
            .withColumn("slot", F.expr(f"_at div {shards}")).drop("_at"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards under the law ``rows``."""
    return (shard_rows(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard"), "row_no"))
