"""Kneser-Ney language models against a plain-Python statement of the
formulas; held-out accuracy, calibration and defined cases."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from commitlens.llm import language_id as li

MID = "/root/testdata/sf0.01"
TEXTS = [("x", "banana bandana ba"), ("x", "an Ananas, a band"), ("x", "naïve ÄÖ ban1ban"), ("y", "zig zag zog"), ("y", "gig ziggy"),
         ("y", "a"), ("x", ""), ("x", "2 + 2")]


def words(text):
    return [w.lower() for w in re.findall(r"(?:[A-Za-z]|[^\x00-\x7f])+", text)]


def brute(texts, order):
    """bits(word) by the definition: dictionaries of n-grams of one language."""
    n = defaultdict(Counter)
    for t in texts:
        for w in words(t):
            s = " " + w + " "
            for i in range(1, len(s)):
                for k in range(1, order + 1):
                    if i - k + 1 >= 0:
                        n[k][s[i - k + 1:i + 1]] += 1
    c = {}
    for k in range(1, order + 1):
        left = Counter(g[1:] for g in n[k + 1]) if k < order else None
        c[k] = {g: v if k == order or (k > 1 and g[0] == " ") else left[g] for g, v in n[k].items()}
    d = {}
    for k in c:
        n1, n2 = (sum(v == t for v in c[k].values()) for t in (1, 2))
        d[k] = min(0.95, n1 / (n1 + 2 * n2)) if n1 else 0.5

    def prob(h, ch):
        k = len(h) + 1
        lower = prob(h[1:], ch) if h else 1 / (len(c[1]) + 1)
        mine = {g: v for g, v in c[k].items() if g[:-1] == h}
        if not mine:
            return lower
        total = sum(mine.values())
        return max(mine.get(h + ch, 0) - d[k], 0) / total + d[k] * len(mine) / total * lower

    def bits(word):
        s = " " + word + " "
        return sum(-math.log2(prob(s[max(0, i - order + 1):i], s[i])) for i in range(1, len(s)))

    return bits


@pytest.mark.parametrize("order", [1, 3, 5])
def test_models_equal_the_formulas(spark, order):
    df = spark.createDataFrame([(v, t) for v, t in TEXTS], "lang string, text string").repartition(3)
    counts = li.gram_counts(df, order).cache()
    got = li.kneser_ney(counts, order).toPandas()
    asked = ["banana", "zig", "qqq", "anzig", "naïve", "ä", "b"]
    for lang in ("x", "y"):
        g = got[got.lang == lang]
        empty = g[g.k == 0].iloc[0]
        g = g[g.k > 0]
        model = li.KneserNey.of(g.gram.to_numpy().view(np.uint64), g.prob.to_numpy(float), g.weight.to_numpy(float), empty.prob * empty.weight)
        bits = brute([t for v, t in TEXTS if v == lang], order)
        for w in asked:
            grams = li.WordGrams(pa.array([w]), order)
            assert model.bits(grams).sum() == pytest.approx(bits(w), abs=1e-9), (lang, w)


def test_probabilities_sum_to_one(spark):
    df = spark.createDataFrame([(v, t) for v, t in TEXTS if v == "y"], "lang string, text string")
    g = li.kneser_ney(li.gram_counts(df, 3), 3).toPandas()
    empty = g[g.k == 0].iloc[0]
    g = g[g.k > 0]
    model = li.KneserNey.of(g.gram.to_numpy().view(np.uint64), g.prob.to_numpy(float), g.weight.to_numpy(float), empty.prob * empty.weight)
    letters = sorted({ch for _, t in TEXTS[3:6] for w in words(t) for ch in w})
    for start in ("", "z", "zi", "gg"):
        total = 0.0
        for ch in letters + ["一"]:  # one unknown
            b = model.bits(li.WordGrams(pa.array([start + ch + "a"]), 3))
            total += 2 ** -b[len(start)]
        end = model.bits(li.WordGrams(pa.array([start or "a"]), 3))
        total += 2 ** -end[len(start)] if start else 0
        if start:
            assert total == pytest.approx(1, abs=1e-9)


def test_held_out_documents(spark):
    docs = li.table(spark, MID, "documents")
    got = li.op13_language_id(spark, MID)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.99
    assert np.mean([r["rejected"] for r in rows]) < 0.02
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_rejection_and_defined_cases(spark):
    docs = li.table(spark, MID, "documents")
    model = li.train(docs)
    odd = [(1, None), (2, ""), (3, "12 34 !?"), (4, "xqzv kjwq zzxv qqkj vvwz xxqj " * 20), (5, "الكتاب على الطاولة في البيت الكبير " * 5),
           (6, "the"), (7, " ".join(f"w{i % 977}x{i}" for i in range(60000))), (None, "der die das und ist nicht"), (6, "the")]
    df = spark.createDataFrame([(i, t, "en", 1.0, "z") for i, t in odd], "doc_id long, text string, lang string, score double, _text string")
    got = {r["doc_id"]: r for r in li.with_language(df, model, ["doc_id"]).collect()}
    for i in (1, 2, 3):
        assert (got[i]["lang_pred"], got[i]["score"], got[i]["rejected"]) == ("und", 0.0, True)
    assert got[4]["rejected"] and got[5]["rejected"] and got[4]["lang_pred"] in model.names
    assert got[7]["lang_pred"] in model.names and got[None]["lang_pred"] in model.names
    empty = df.filter("1 = 0")
    assert li.with_language(empty, model, ["doc_id"]).collect() == []
    none = li.train(empty)
    assert none.names == []
    assert {r["lang_pred"] for r in li.with_language(df, none, ["doc_id"]).collect()} == {"und"}
    one = li.train(docs.filter("lang = 'de'"))
    assert one.names == ["de"] and li.with_language(docs.limit(3), one, ["doc_id"]).first()["lang_pred"] == "de"


def test_sample_is_bounded_and_copies_count_once(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "b").when(F.col("id") % 7 != 0, "a").alias("lang"),
                                    F.when(F.col("id") % 3 == 0, "the same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    got = li.training_sample(docs, rows=100).collect()
    by = Counter(r["lang"] for r in got)
    assert 60 <= by["a"] <= 100 and 60 <= by["b"] <= 100 and None not in by
    assert max(Counter((r["lang"], r["text"]) for r in got).values()) == 1
