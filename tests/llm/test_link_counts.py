"""Numbers of links against all pairs in plain Python."""

import random
import re
from collections import defaultdict

import duckdb
import numpy as np

from commitlens.llm import jaccard_join as jj
from commitlens.llm.graph import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0D]+")
LOW = {65 + i: 97 + i for i in range(26)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOW))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked(a, b):
    both = len(a & b)
    return 100 * both >= 75 * (len(a) + len(b) - both)


def brute(rows):
    """{set: number of other sets it links with}, by an inverted index."""
    sets = {shingles(t) for _, t in rows} - {frozenset()}
    posting = defaultdict(set)
    for s in sets:
        for x in s:
            posting[x].add(s)
    return {s: sum(linked(s, o) for o in set().union(*(posting[x] for x in s)) if o != s) for s in sets}


def near_copies(n, words, edits, seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(r.randrange(edits + 1)):
            own[r.randrange(words)] = f"e{r.randrange(10 ** 6)}"
        out.append(" ".join(own))
    return out


def test_count_links_in_blocks():
    r = np.random.default_rng(2)
    base = r.integers(0, 1 << 60, 9000).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[:n], r.integers(0, 1 << 60, k).astype(np.uint64)]))
            for n, k in zip(r.integers(1, 9000, 40), r.integers(0, 3000, 40))]
    want = np.array([[linked(set(a.tolist()), set(b.tolist())) for b in sets] for a in sets])
    np.fill_diagonal(want, False)
    assert (jj.count_links(sets)[0] == want.sum(1)).all()
    a, b = jj.count_links(sets[:15], sets[15:])
    assert (a == want[:15, 15:].sum(1)).all() and (b == want[:15, 15:].sum(0)).all()


def test_large_group_of_near_copies(spark):
    block = 900  # of the group's 17,000 shingles
    texts = near_copies(150, 120, 4, 3) + near_copies(20, 400, 30, 4) + ["a b c", "a b c", "", None, "one two three four five six"]
    rows = list(enumerate(texts)) + [(7, texts[8])]
    join = jj.JaccardJoin(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    counts = {r["cls"]: r["n_links"] for r in join.link_counts(components(join.links()), block).collect()}
    want = brute(rows)
    got = {r["doc_id"]: counts.get(r["cls"], 0) for r in join.info.select("doc_id", "cls").collect() if r["doc_id"] != 7}
    assert got == {d: want.get(shingles(t), 0) for d, t in rows if d != 7}
    assert max(want.values()) > 60


def test_query_counts_every_link(spark):
    rows = duckdb.sql(f"select doc_id, text from '{SMALL}/documents.parquet'").fetchall()
    want = brute(rows)
    got = {r["doc_id"]: r["n_links"] for r in jj.op2_ngram_jaccard_join(spark, SMALL).collect()}
    assert got == {d: want.get(shingles(t), 0) for d, t in rows} and sum(got.values()) > 0
