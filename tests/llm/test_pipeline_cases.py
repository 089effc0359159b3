"""The pipeline over odd rows, and the toxicity network against plain loops."""

import re

import numpy as np
import pyarrow as pa

from commitlens.llm import toxicity
from commitlens.session import scratch_path

WORD = re.compile("[^\x20\x09-\x0D]+")


def test_all_stages_over_nulls_and_repeated_rows(spark):
    import corpus_pipeline

    near = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90))
    rows = [(1, near), (2, near + " more"), (2, near + " more"), (3, None), (3, None), (4, ""), (None, "a text without an id at all"),
            (None, None), (5, "short one"), (5, "short one"), (5, "another text of id five"), (6, " \t ")]
    sf = scratch_path(spark, "pipeline-cases")
    docs = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(sf + "/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(sf + "/labels.parquet")
    got = [tuple(r) for r in corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens").collect()]
    # nothing is toxic to an untrained network, no line recurs; one row of the near copies stays, empty sets all do
    # but rows that repeat an id and a text count once
    assert sorted(n for d, n in got if d is None) == [1, 8]
    by_id = sorted((d, n) for d, n in got if d is not None)
    assert by_id == [(1, 91), (3, 1), (4, 1), (5, 3), (5, 6), (6, 1)]


def plain_logit(p, word_vectors):
    """One window, step by step, in 64 bits."""
    h = toxicity.HIDDEN
    p = {k: v.astype(float) for k, v in p.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))
    both = []
    for k, seq in enumerate((word_vectors, word_vectors[::-1])):
        state, states = np.zeros(h), []
        for x in seq:
            a, g = x @ p["w"][k] + p["b"][k], state @ p["u"][k]
            z, r = sig(a[:h] + g[:h]), sig(a[h:2 * h] + g[h:2 * h])
            new = np.tanh(a[2 * h:] + r * g[2 * h:])
            state = z * state + (1 - z) * new
            states.append(state)
        both.append(states if k == 0 else states[::-1])
    both = [np.concatenate(x) for x in zip(*both)]
    score = np.array([np.tanh(s @ p["wa"] + p["ba"]) @ p["va"] for s in both])
    weight = np.exp(score - score.max())
    return (weight / weight.sum()) @ np.array(both) @ p["o"] + p["bo"][0]


def test_forward_pass_equals_plain_loops():
    net = toxicity.BiGru(seed=5)
    texts = ["one two three", "A single", " ".join(f"w{i % 7}" for i in range(130)), "x"]
    words = toxicity.Words(pa.array(texts, pa.string()))
    windows, text = words.windows()
    got, vectors = net.logits(words, windows), net.inputs(words).astype(float)
    assert len(windows) > len(texts)
    for w, g in zip(windows, got):
        assert abs(plain_logit(net.p, [vectors[c] for c in w if c >= 0]) - g) < 1e-4
    # all windows of a text, overlapping by half, are looked at
    assert [int((text == k).sum()) for k in range(4)] == [1, 1, -(-(130 - toxicity.WINDOW) // toxicity.STRIDE) + 1, 1]
    scores = toxicity.score_texts(net, pa.array(texts, pa.string()))
    assert abs(scores[2] - 1 / (1 + np.exp(-max(got[text == 2])))) < 1e-6
