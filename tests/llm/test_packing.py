"""Optimal buckets for exact lengths, and the whole query recomputed."""

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from commitlens.llm import packing

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")


def least_padding(cells, buckets):
    """Plain quadratic program over all lengths."""
    top = [t for t, _ in cells]
    seen = np.concatenate([[0], np.cumsum([n for _, n in cells])])
    best = [0] + [float("inf")] * len(top)
    for _ in range(buckets):
        best = [0] + [min(best[i] + top[j - 1] * (seen[j] - seen[i]) for i in range(j)) for j in range(1, len(top) + 1)]
    return best[-1] - sum(t * n for t, n in cells)


def padding(cells, bounds):
    return sum((min(b for b in bounds if b >= t) - t) * n for t, n in cells)


@pytest.mark.parametrize("seed, most, buckets", [(1, 60, 1), (2, 400, 5), (3, 20_000, 16), (4, 20_000, 3), (5, 2_000, 300)])
def test_boundaries_are_optimal(seed, most, buckets):
    r = np.random.default_rng(seed)
    lengths = np.minimum(most, 1 + (r.pareto(1.1, 500) * 40).astype(int))
    cells = sorted((t, n * int(r.integers(1, 50))) for t, n in Counter(lengths.tolist()).items())
    got = packing.best_boundaries(cells, buckets)
    assert got == sorted(set(got)) and len(got) <= buckets and got[-1] == cells[-1][0]
    assert padding(cells, got) == least_padding(cells, min(buckets, len(cells)))


def test_few_lengths_and_ties():
    assert packing.best_boundaries([], 4) == []
    assert packing.best_boundaries([(7, 3)], 4) == [7]
    assert padding([(1, 1), (2, 1), (3, 1)], packing.best_boundaries([(1, 1), (2, 1), (3, 1)], 2)) == 1


def test_lengths_beyond_a_thousand_stay_exact(spark):
    """Two long lengths that differ by one get buckets of their own."""
    df = spark.createDataFrame([(i, "w " * n) for i, n in enumerate([5000, 5001, 9000, 9001, 10, 3])], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_tokens"], r["padded_length"]) for r in packing.pack(df, buckets=6).collect()}
    assert all(a == b for a, b in got.values()) and got[1][0] == 5002


def test_query_equals_brute_force(spark):
    docs = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    length = {d: len(WORD.findall(t or "")) + 1 for d, t in docs}
    got = {r["doc_id"]: r for r in packing.op4_packing(spark, SMALL).collect()}
    cells = sorted(Counter(length.values()).items())
    bounds = sorted({r["padded_length"] for r in got.values()})
    assert len(bounds) <= 16 and padding(cells, bounds) == least_padding(cells, 16)
    groups = defaultdict(list)
    for d, n in length.items():
        groups[min(b for b in bounds if b >= n)].append(d)
    for bound, ids in groups.items():
        per = max(1, 16_384 // bound)
        for k, d in enumerate(sorted(ids)):
            assert (got[d]["n_tokens"], got[d]["padded_length"], got[d]["batch"], got[d]["slot"]) == (length[d], bound, k // per, k % per)


def test_one_hot_length(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a b c").otherwise("x").alias("text"))
    rows = packing.pack(df, buckets=2, budget=8).collect()
    assert len(rows) == 2000 and {r["padded_length"] for r in rows} == {2, 4}
    assert max(Counter((r["bucket"], r["batch"]) for r in rows).values()) == 4
