"""Length buckets with minimal padding, and token-budget batches.

The global length histogram is one aggregation; it has a row per length
that occurs, so it is bounded by the longest document, however many there
are.  Dynamic programming over it picks the ``buckets`` boundaries that
minimise the total padding when every document is padded to its bucket's
boundary; boundaries are lengths that occur.  The best cut of a length
never lies before that of a shorter one, so each layer of the program is
solved by halving: a level of mid-points at a time, each within the cuts of
its neighbours.  Inside a bucket documents are numbered
in ascending id order without a task per bucket (``common.numbered``), and
every ``max(1, budget div boundary)`` of them form a batch.

Defined cases: the length is the number of words plus one end token, so
null and empty texts have length 1; a document longer than the budget is
a batch of its own; null ids come first; repeated ids stay separate rows;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import numbered, stored, table

WORD = r"[^\x20\x09-\x0D]+"


def word_length(text: str = "text") -> Column:
    """Words of the whole text plus the end token."""
    return (F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)) + 1).cast("long")


def histogram(lengths: DataFrame, col: str = "n_tokens") -> list[tuple[int, int]]:
    """Ascending (length, rows)."""
    return sorted((r[0], r[1]) for r in lengths.groupBy(col).agg(F.count(F.lit(1)).alias("_n")).collect())


def _layer(best: np.ndarray, top: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every j the least ``best[i] + top[j - 1] * (seen[j] - seen[i])``
    over i < j, and the first such i; j = 0 costs nothing."""
    m = len(top)
    now, cut = np.zeros(m + 1), np.zeros(m + 1, np.int64)
    # open ranges of j, and the cuts that bound them
    j0, j1, i0, i1 = (np.array([x]) for x in (1, m, 0, m - 1))
    while len(j0):
        mid = (j0 + j1) // 2
        size = np.minimum(i1, mid - 1) - i0 + 1
        begin = np.cumsum(size) - size
        i = np.arange(size.sum()) + np.repeat(i0 - begin, size)
        at = np.repeat(mid, size)
        cost = best[i] + top[at - 1] * (seen[at] - seen[i])
        low = np.minimum.reduceat(cost, begin)
        hit = np.flatnonzero(cost == np.repeat(low, size))
        pick = i[hit[np.searchsorted(hit, begin)]]
        now[mid], cut[mid] = low, pick
        left, right = mid > j0, mid < j1
        j0, j1, i0, i1 = (np.concatenate(x) for x in (
            (j0[left], mid[right] + 1), (mid[left] - 1, j1[right]), (i0[left], pick[right]), (pick[left], i1[right])))
    return now, cut


def best_boundaries(cells: list[tuple[int, int]], buckets: int) -> list[int]:
    """The at most ``buckets`` boundaries of least padding, ascending."""
    if not cells:
        return []
    top = np.array([t for t, _ in cells], float)
    seen = np.concatenate([[0.0], np.cumsum([n for _, n in cells], dtype=float)])
    m = len(cells)
    best = np.full(m + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, m)):
        best, cut = _layer(best, top, seen)
        cuts.append(cut)
    out, j = [], m
    for cut in reversed(cuts):
        if j == 0:
            break
        out.append(int(top[j - 1]))
        j = int(cut[j])
    return out[::-1]


def pack(df: DataFrame, buckets: int = 16, budget: int = 16_384, length: Column | None = None,
         id_col: str = "doc_id") -> DataFrame:
    """``doc_id, n_tokens, bucket, padded_length, batch, slot`` of every row."""
    rows = stored(df.select(F.col(id_col).alias("doc_id"), (word_length() if length is None else length).alias("n_tokens")), "lengths")
    bounds = best_boundaries(histogram(rows), buckets)
    if not bounds:
        bounds = [1]
    edges = F.array(*[F.lit(b).cast("long") for b in bounds])
    rows = rows.withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("n_tokens"))))
    rows = numbered(rows, ["doc_id", "n_tokens"], ["bucket"], "_no")
    return (rows.withColumn("padded_length", F.element_at(edges, F.col("bucket") + 1))
            .withColumn("_per", F.greatest(F.lit(1).cast("long"), F.expr(f"{budget}L div padded_length")))
            .select("doc_id", "n_tokens", "bucket", "padded_length",
                    F.expr("_no div _per").alias("batch"), F.expr("_no % _per").alias("slot")))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 buckets and batches of 16,384 padded tokens."""
    return pack(table(spark, sf_dir, "documents"))
