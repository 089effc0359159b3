"""Toxicity by a bidirectional GRU with attention pooling, in numpy.

Input at every word is its word embedding (hashed) next to the mean
embedding of its byte n-grams (hashed, with word boundaries), i.e. word and
character inputs.  A gated recurrent unit runs over each window of
``WINDOW`` words in both directions, attention pools its states, and a
logistic unit scores the window.  All windows of a text, overlapping by
half, are scored; the text's score is that of its worst window.

Training takes at most ``SAMPLE`` labelled rows of each class -- the
documented bound of this operator -- from rows whose crc32 of the id as
text is not divisible by ``FOLDS``, chosen by a hash of their id.  A
document's label belongs to its worst window, so each epoch trains on the
windows that score highest at its start.  Labels, language, source and id
are no inputs.

Defined cases: null and empty texts are one window of no words and get the
score of the bias; labels without a document, null labels and null ids are
not learned from; a table without labels, or with one class only, gives the
untrained network's scores; repeated rows are scored alike; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import U64, mix64, table
from commitlens.llm.textkit import _LOWER, NON_ALNUM, text_bytes, word_hashes, word_spans

FOLDS = 5
SAMPLE = 1200
WINDOW, STRIDE = 48, 24
WORD_ROWS, GRAM_ROWS, DIM, HIDDEN = 1 << 14, 1 << 14, 8, 12
GRAMS = (3, 5)
EPOCHS, BATCH, RATE, HIDE, DECAY = 12, 192, 0.015, 0.5, np.float32(1e-4)


class Words:
    """Distinct words of some texts: word row, n-gram rows (CSR), and the
    windows of every text as indices into them (-1: padding)."""

    def __init__(self, col: pa.Array):
        raw, off = text_bytes(col)
        starts, ends, self.rows, _, _ = word_spans(raw, off, NON_ALNUM)
        hashes, _ = word_hashes(col, NON_ALNUM)
        uniq, first, self.code = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (mix64(uniq) % U64(WORD_ROWS)).astype(np.int64)
        s, n = starts[first], ends[first] - starts[first]
        # bytes of all distinct words, each between boundary marks
        size = n + 2
        at = np.concatenate([[0], np.cumsum(size)])
        inside = np.arange(at[-1]) - np.repeat(at[:-1], size)
        src = np.clip(np.repeat(s, size) + inside - 1, 0, max(0, len(raw) - 1))
        flat = _LOWER[raw[src]].astype(U64) if len(raw) else np.zeros(len(src), U64)
        flat[inside == 0] = 2
        flat[inside == np.repeat(size, size) - 1] = 3
        owner = np.repeat(np.arange(len(uniq)), size)
        left = np.repeat(size, size) - inside
        own, gram = [], []
        with np.errstate(over="ignore"):
            for g in GRAMS:
                h = np.zeros(max(0, len(flat) - g + 1), U64)
                for k in range(g):
                    h = h * U64(1099511628211) + flat[k:k + len(h)] + U64(g)
                ok = left[:len(h)] >= g
                own.append(owner[:len(h)][ok])
                gram.append((mix64(h[ok]) % U64(GRAM_ROWS)).astype(np.int64))
        own, gram = np.concatenate(own), np.concatenate(gram)
        order = np.argsort(own, kind="stable")
        self.gram = gram[order]
        self.begin = np.searchsorted(own[order], np.arange(len(uniq)))
        self.count = np.bincount(own, minlength=len(uniq)).astype(np.float32)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(windows, WINDOW) codes and the text of each window."""
        begin, end = self.rows[:-1], self.rows[1:]
        number = np.maximum(1, -(-(end - begin - WINDOW) // STRIDE) + 1)
        text = np.repeat(np.arange(len(begin)), number)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
        at = (begin[text] + nth * STRIDE)[:, None] + np.arange(WINDOW)
        ok = at < end[text][:, None]
        codes = self.code[np.minimum(at, max(0, len(self.code) - 1))] if len(self.code) else np.zeros(at.shape, np.int64)
        return np.where(ok, codes, -1), text


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


class BiGru:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = np.float32
        d, h = 2 * DIM, HIDDEN
        self.p = {
            "word": r.normal(0, 0.1, (WORD_ROWS, DIM)).astype(f), "gram": r.normal(0, 0.3, (GRAM_ROWS, DIM)).astype(f),
            "w": r.normal(0, d ** -0.5, (2, d, 3 * h)).astype(f), "b": np.zeros((2, 3 * h), f),
            "u": r.normal(0, h ** -0.5, (2, h, 3 * h)).astype(f),
            "wa": r.normal(0, (2 * h) ** -0.5, (2 * h, h)).astype(f), "ba": np.zeros(h, f), "va": r.normal(0, 1, h).astype(f),
            "o": r.normal(0, (2 * h) ** -0.5, 2 * h).astype(f), "bo": np.full(1, -1, f)}

    def inputs(self, ws: Words) -> np.ndarray:
        """(distinct words + 1, 2 DIM); the last row is the padding."""
        x = np.zeros((len(ws.word) + 1, 2 * DIM), np.float32)
        x[:-1, :DIM] = self.p["word"][ws.word]
        if len(ws.word):
            x[:-1, DIM:] = np.add.reduceat(self.p["gram"][ws.gram], ws.begin) / np.sqrt(ws.count)[:, None]
        return x

    def run(self, a: np.ndarray, mask: np.ndarray, keep: bool = False) -> tuple:
        """a: (2, T, B, 3H) projected inputs, the second direction already
        reversed in time; mask: (2, T, B, 1)."""
        p, h = self.p, HIDDEN
        _, t, n, _ = a.shape
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((2, t, n, h), np.float32)
        kept = []
        for i in range(t):
            g = state @ p["u"]
            zr = _sigmoid(a[:, i, :, :2 * h] + g[..., :2 * h])
            z, r = zr[..., :h], zr[..., h:]
            new = np.tanh(a[:, i, :, 2 * h:] + r * g[..., 2 * h:])
            step = (1 - z) * (new - state) * mask[:, i]
            if keep:
                kept.append((state, z, r, new, g[..., 2 * h:]))
            state = state + step
            states[:, i] = state
        both = np.concatenate([states[0], states[1][::-1]], -1)  # (T, B, 2H)
        e = np.tanh(both @ p["wa"] + p["ba"])
        m = mask[0]
        score = np.where(m > 0, (e @ p["va"])[..., None], -1e9)
        alpha = np.exp(score - score.max(0)) * m
        alpha = alpha / np.maximum(alpha.sum(0), 1e-9)
        pooled = (alpha * both).sum(0)
        logit = pooled @ p["o"] + p["bo"]
        return logit, (kept, both, e, alpha, pooled)

    def project(self, x: np.ndarray) -> np.ndarray:
        return np.stack([x @ self.p["w"][k] + self.p["b"][k] for k in (0, 1)])

    def logits(self, ws: Words, windows: np.ndarray, batch: int = 512) -> np.ndarray:
        px = self.project(self.inputs(ws))
        out = np.empty(len(windows), np.float32)
        for i in range(0, len(windows), batch):
            w = windows[i:i + batch].T
            m = (w >= 0)[..., None].astype(np.float32)
            used = max(1, int(m.any(1).sum()))
            w, m = w[:used], m[:used]
            a = np.stack([px[0][w], px[1][w[::-1]]])
            out[i:i + batch] = self.run(a, np.stack([m, m[::-1]]))[0]
        return out

    def gradients(self, ws: Words, windows: np.ndarray, y: np.ndarray, hidden: np.ndarray | None = None) -> dict[str, np.ndarray]:
        """Gradients of the mean log loss; ``hidden`` words show only their
        characters."""
        p, h = self.p, HIDDEN
        x = self.inputs(ws)
        if hidden is not None:
            x[:-1][hidden, :DIM] = 0
        w = windows.T
        m = (w >= 0)[..., None].astype(np.float32)
        used = max(1, int(m.any(1).sum()))
        w, m = w[:used], m[:used]
        mask = np.stack([m, m[::-1]])
        px = self.project(x)
        logit, (kept, both, e, alpha, pooled) = self.run(np.stack([px[0][w], px[1][w[::-1]]]), mask, keep=True)
        t, n = w.shape
        dl = (_sigmoid(logit) - y) / n
        g = {"o": pooled.T @ dl, "bo": dl.sum(keepdims=True)}
        dp = dl[:, None] * p["o"]
        da = (both * dp).sum(-1, keepdims=True)
        ds = alpha * (da - (alpha * da).sum(0))
        de = ds * p["va"] * (1 - e * e)
        g["va"] = (e * ds).sum((0, 1))
        g["wa"] = both.reshape(-1, 2 * h).T @ de.reshape(-1, h)
        g["ba"] = de.sum((0, 1))
        dboth = alpha * dp + de @ p["wa"].T
        dstates = np.stack([dboth[..., :h], dboth[::-1, :, h:]])
        carry = np.zeros((2, n, h), np.float32)
        dproj = np.empty((2, t, n, 3 * h), np.float32)
        du = np.zeros_like(p["u"])
        ut = p["u"].transpose(0, 2, 1)
        for i in reversed(range(t)):
            state, z, r, new, gn = kept[i]
            carry = carry + dstates[:, i]
            dm = carry * mask[:, i]
            dnew = dm * (1 - z) * (1 - new * new)
            dz = dm * (state - new) * z * (1 - z)
            dr = dnew * gn * r * (1 - r)
            dproj[:, i] = np.concatenate([dz, dr, dnew], -1)
            dg = np.concatenate([dz, dr, dnew * r], -1)
            du += state.transpose(0, 2, 1) @ dg
            carry = carry - dm * (1 - z) + dg @ ut
        g["u"] = du
        dx = np.zeros_like(x)
        g["w"], g["b"] = np.empty_like(p["w"]), dproj.sum((1, 2))
        for k, codes in enumerate((w, w[::-1])):
            flat = codes.reshape(-1)
            d = dproj[k].reshape(-1, 3 * h)
            g["w"][k] = x[flat].T @ d
            np.add.at(dx, flat, d @ p["w"][k].T)
        dx = dx[:-1]
        g["word"], g["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        if hidden is not None:
            dx[hidden, :DIM] = 0
        hit = np.flatnonzero(np.abs(dx).sum(1))
        np.add.at(g["word"], ws.word[hit], dx[hit, :DIM])
        sizes = ws.count[hit].astype(np.int64)
        at = np.repeat(ws.begin[hit] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        np.add.at(g["gram"], ws.gram[at], np.repeat(dx[hit, DIM:] / np.sqrt(ws.count[hit])[:, None], sizes, 0))
        return g

    def fit(self, texts: list[str], labels: np.ndarray, seed: int = 3) -> "BiGru":
        ws = Words(pa.array(texts, pa.string()))
        windows, text = ws.windows()
        first = np.searchsorted(text, np.arange(len(texts)))
        rng = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.p.items()}
        square = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        span = np.diff(np.append(first, len(text)))
        batch = min(BATCH, max(16, len(texts) // 8))  # eight steps an epoch at least
        for epoch in range(EPOCHS):
            some = first + (rng.random(len(texts)) * span).astype(np.int64)
            if epoch:
                logit = self.logits(ws, windows)
                order = np.lexsort((logit, text))
                worst = order[np.append(first[1:], len(text)) - 1]
                pick = np.concatenate([worst, some[labels == 0]])
            else:
                pick = some
            pick = rng.permutation(pick)
            for i in range(0, len(pick), batch):
                at = pick[i:i + batch]
                grads = self.gradients(ws, windows[at], labels[text[at]].astype(np.float32),
                                       rng.random(len(ws.word)) < HIDE)
                step += 1
                rate = RATE * (1 - 0.8 * epoch / EPOCHS)
                for k, gk in grads.items():
                    gk = gk + DECAY * self.p[k]
                    mean[k] = 0.9 * mean[k] + 0.1 * gk
                    square[k] = 0.99 * square[k] + 0.01 * gk * gk
                    self.p[k] -= (rate * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
        return self


def score_texts(model: BiGru, col: pa.Array) -> np.ndarray:
    """Probability of the worst window of every text."""
    if not len(col):
        return np.zeros(0)
    ws = Words(col)
    windows, text = ws.windows()
    worst = np.maximum.reduceat(model.logits(ws, windows), np.searchsorted(text, np.arange(len(col))))
    return 1 / (1 + np.exp(-np.clip(worst.astype(float), -30, 30)))


def fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> BiGru:
    """Fit on at most ``sample`` rows of each class outside the held-out
    fold, taken in the order of a hash of the id.  The fit is one task on
    these rows; only the parameters come to the driver."""
    known = (labels.filter("toxic is not null and doc_id is not null").select("doc_id", "toxic").filter(fold() != 0)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    ids = [known.filter(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for y in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(ids[0].union(ids[1])), "doc_id").select("doc_id", "toxic", "text")

    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = {i: (y, t or "") for b in batches for i, y, t in zip(*(c.to_pylist() for c in b.columns))}
        order = sorted(got, key=lambda i: (got[i][0], i))
        ys = np.array([got[i][0] for i in order])
        if len(set(ys.tolist())) == 2:
            net = BiGru().fit([got[i][1] for i in order], ys)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net.p)], pa.binary())], ["model"])

    model = BiGru()
    for r in rows.repartition(1).mapInArrow(fit, "model binary").collect():
        model.p = pickle.loads(r["model"])
    return model


def with_scores(df: DataFrame, model: BiGru, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every row and its ``score``."""
    shared = df.sparkSession.sparkContext.broadcast(model.p)
    rows = df.select(F.col(text_col).alias("_text"), *keep)
    out = rows.drop("_text").withColumn("score", F.lit(0.0)).schema

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = BiGru.__new__(BiGru)
        net.p = shared.value
        for b in batches:
            for a in range(0, b.num_rows, 256):
                s = b.slice(a, 256)
                yield pa.RecordBatch.from_arrays([*s.columns[1:], pa.array(score_texts(net, s.column(0)))],
                                                 [*s.schema.names[1:], "score"])

    return rows.mapInArrow(score, out)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    scored = with_scores(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
