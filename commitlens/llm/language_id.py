"""Language identification by interpolated Kneser-Ney character models.

One model per language.  A text is read as words (runs of letters and of
characters beyond ASCII, lower-cased), each between boundary marks; a
character is predicted from up to ``ORDER - 1`` characters before it in
its word.  Orders are interpolated with absolute discounts n1 / (n1 + 2
n2); all orders but the highest count the distinct characters to the left
of an n-gram instead of its occurrences (n-grams that begin a word have
none, so they keep their occurrences), and the lowest is interpolated with
the uniform distribution over the characters of the model and one unknown.

A model is one sorted array of 64-bit n-gram hashes with two parallel
arrays, log probability and log weight of the next lower order, and a
directory of the first place of every value of the hashes' leading bits.  A text
goes to the language of the lowest cross-entropy per character, ties to
the first name.

Learning takes rows with a language whose crc32 of the id as text is not
divisible by ``FOLDS``; of those at most ``SAMPLE`` rows a language, by a
hash of the id, and of all languages together about ``SAMPLE_BYTES`` of
text (whole texts, equal ones once) -- the documented bound of this
operator, which also bounds the models' size.  N-gram counts and the statistics of
Kneser-Ney smoothing are aggregations; the models reach the driver as
(language, hash, two numbers) and go to the executors as a broadcast.

An eighth of the sample is kept out of the counts and calibrates: ``score``
is the probability that the chosen language is right, a logistic function
of the margin to the second language in standard errors; ``rejected`` tells
that the text looks like none of the languages, i.e. its cross-entropy lies
above what all but ``REJECT`` of the calibration texts of the chosen
language reach, in standard errors of its length, or its score below one half.

Defined cases: null texts and texts without a letter are ``und`` with score
0 and rejected, as is every text if nothing could be learned; null ids are
not held out and not learned from; repeated rows are judged alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.llm.common import U64, mix64, stored, table
from commitlens.llm.textkit import text_bytes, word_hashes, word_spans

FOLDS = 5
ORDER = 5
SAMPLE, SAMPLE_BYTES = 4000, 24_000_000
REJECT = 0.001
UNKNOWN = "und"
#: Bytes of text that are looked at together.
PIECE_BYTES = 4_000_000

#: ASCII bytes that are no letters end a word.
NO_LETTER = np.array([b < 128 and not chr(b).isalpha() for b in range(256)])
MARK = 32  # the boundary of a word; no word holds it
_STEP = U64(0x9E3779B97F4A7C15)


class WordGrams:
    """Distinct words of some texts and all n-grams that end in them.

    ``rows``: n+1 word offsets of the texts, ``code``: the distinct word of
    every word.  ``grams[k]``: hash of the n-gram of order k + 1 that ends
    at a character (word characters and the closing mark), valid where
    ``depth`` > k; ``owner``: the distinct word of a character."""

    def __init__(self, col: pa.Array, order: int = ORDER):
        raw, off = text_bytes(col)
        starts, ends, self.rows, _, _ = word_spans(raw, off, NO_LETTER)
        hashes, _ = word_hashes(col, NO_LETTER)
        _, first, self.code = np.unique(hashes, return_index=True, return_inverse=True)
        s, n = starts[first], ends[first] - starts[first]
        size = n + 1  # the word and the mark after it
        at = np.concatenate([[0], np.cumsum(size)])
        inside = np.arange(at[-1]) - np.repeat(at[:-1], size)
        flat = np.full(len(inside) + 1, MARK, np.uint8)
        body = inside < np.repeat(n, size)
        flat[1:][body] = raw[(np.repeat(s, size) + inside)[body]]
        self.count = len(first)
        chars = np.frombuffer(flat.tobytes().decode().lower().encode("utf-32-le"), np.uint32).astype(U64)
        marks = np.flatnonzero(chars == MARK)  # before the first word and after every word
        place = np.arange(1, len(chars))
        word = np.searchsorted(marks, place) - 1
        self.owner = word
        # characters from the word's opening mark to here
        since = place - marks[word] + 1
        self.depth = np.minimum(since, order)
        self.opens = self.depth == since  # the longest n-gram begins with the opening mark
        self.grams = np.empty((order, len(place)), U64)
        h = np.zeros(len(place), U64)
        with np.errstate(over="ignore"):
            for k in range(order):
                # read from right to left, so that order k + 1 extends order k
                h = mix64(h * _STEP + chars[np.maximum(place - k, 0)] + U64(k + 1))
                self.grams[k] = h
            # the same contexts without the last character, for their weights
            self.contexts = np.empty((order, len(place)), U64)
            h = np.zeros(len(place), U64)
            self.contexts[0] = 0
            for k in range(1, order):
                h = mix64(h * _STEP + chars[np.maximum(place - k, 0)] + U64(k))
                self.contexts[k] = h


def gram_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, k, gram, context, lower, opens, n``: occurrences of every
    n-gram of order k with its context (n-gram without the last character),
    its ending of order k - 1 and whether it begins a word."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in pieces(b, 1):
                langs = np.array(s.column(0).to_pylist(), object)
                grams = WordGrams(s.column(1), order)
                text = np.repeat(np.arange(s.num_rows), np.diff(grams.rows))
                for lang in sorted(set(langs.tolist())):
                    times = np.bincount(grams.code[langs[text] == lang], minlength=grams.count)[grams.owner]
                    for k in range(order):
                        use = np.flatnonzero((times > 0) & (grams.depth > k))
                        g, first, back = np.unique(grams.grams[k][use], return_index=True, return_inverse=True)
                        n = np.bincount(back, times[use], len(g)).astype(np.int64)
                        at = use[first]
                        lower = grams.grams[k - 1][at] if k else np.zeros(len(at), U64)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(g), pa.string()), pa.array(np.full(len(g), k + 1, np.int32)), pa.array(g.view(np.int64)),
                             pa.array(grams.contexts[k][at].view(np.int64)), pa.array(lower.view(np.int64)),
                             pa.array(grams.opens[at] & (grams.depth[at] == k + 1)), pa.array(n)],
                            ["lang", "k", "gram", "context", "lower", "opens", "n"])

    seen = sample.select("lang", "text").mapInArrow(
        count, "lang string, k int, gram long, context long, lower long, opens boolean, n long")
    return seen.groupBy("lang", "k", "gram").agg(F.first("context").alias("context"), F.first("lower").alias("lower"),
                                                 F.first("opens").alias("opens"), F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang, k, gram, prob, weight``: interpolated probabilities of all
    n-grams, and the weight that they give the next lower order where they
    are contexts (null where they never are)."""
    # left continuations: how many n-grams of the next order end in this one
    left = counts.filter("k > 1").groupBy("lang", (F.col("k") - 1).alias("k"), F.col("lower").alias("gram")).agg(F.count(F.lit(1)).alias("left"))
    c = counts.join(left, ["lang", "k", "gram"], "left").withColumn(
        "c", F.when((F.col("k") == order) | F.col("opens"), F.col("n")).otherwise(F.coalesce("left", F.col("n"))))
    c = stored(c.select("lang", "k", "gram", "context", "lower", "c"), "grams")
    ones = c.groupBy("lang", "k").agg(F.count_if(F.col("c") == 1).alias("n1"), F.count_if(F.col("c") == 2).alias("n2"))
    discount = ones.select("lang", "k", F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
                           .alias("d")).withColumn("d", F.least(F.col("d"), F.lit(0.95)))
    context = c.join(discount, ["lang", "k"]).groupBy("lang", "k", "context").agg(
        F.sum("c").alias("total"), (F.count(F.lit(1)) * F.first("d")).alias("left_over"), F.first("d").alias("d"))
    context = context.withColumn("weight", F.col("left_over") / F.col("total"))
    terms = c.join(context, ["lang", "k", "context"]).withColumn("own", F.greatest(F.col("c") - F.col("d"), F.lit(0.0)) / F.col("total"))
    terms = stored(terms.select("lang", "k", "gram", "lower", "own", "weight"), "terms")
    alphabet = terms.filter("k = 1").groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("size"))
    prob = terms.filter("k = 1").join(alphabet, "lang").select("lang", "gram", (F.col("own") + F.col("weight") / F.col("size")).alias("prob"))
    out = prob.withColumn("k", F.lit(1))
    for k in range(2, order + 1):
        below = prob.select("lang", F.col("gram").alias("lower"), F.col("prob").alias("below"))
        prob = terms.filter(F.col("k") == k).join(below, ["lang", "lower"]).select(
            "lang", "gram", (F.col("own") + F.col("weight") * F.col("below")).alias("prob"))
        out = out.unionByName(prob.withColumn("k", F.lit(k)))
    # a context of order k + 1 is an n-gram of order k; the empty one is kept as order 0
    weights = context.select("lang", (F.col("k") - 1).alias("k"), F.col("context").alias("gram"), "weight")
    sizes = alphabet.select("lang", F.lit(0).alias("k"), F.lit(0).cast("long").alias("gram"), (1 / F.col("size")).alias("prob"))
    return out.unionByName(sizes).join(weights, ["lang", "k", "gram"], "full_outer")


@dataclass
class KneserNey:
    """One language: sorted hashes, log2 probabilities (nan: only a
    context) and log2 weights (0: never a context), and of the empty
    context the uniform probability and its weight."""

    hashes: np.ndarray
    prob: np.ndarray
    weight: np.ndarray
    unseen: float
    #: how far to shift a hash for its leading bits, their first places, and the most places of one
    shift: int
    place: np.ndarray
    crowd: int

    @classmethod
    def of(cls, gram: np.ndarray, prob: np.ndarray, weight: np.ndarray, unseen: float) -> "KneserNey":
        order = np.argsort(gram)
        bits = max(1, len(gram).bit_length() + 1)
        hashes = np.append(gram[order], gram.max(initial=U64(0)))  # one more place to look at
        place = np.searchsorted(hashes[:-1] >> U64(64 - bits), np.arange((1 << bits) + 1, dtype=U64))
        with np.errstate(divide="ignore"):
            return cls(hashes, np.log2(prob[order]), np.where(np.isnan(weight[order]), 0.0, np.log2(weight[order])), float(np.log2(unseen)),
                       64 - bits, place, int(np.diff(place).max(initial=0)))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Place of every hash, -1 if it is not there."""
        last = len(self.prob)
        at = self.place[h >> U64(self.shift)]
        found = self.hashes[at] == h
        miss = np.flatnonzero(~found)
        for k in range(1, self.crowd):
            near = np.minimum(at[miss] + k, last)
            hit = self.hashes[near] == h[miss]
            at[miss[hit]], found[miss[hit]] = near[hit], True
            miss = miss[~hit & (self.hashes[near] <= h[miss])]
        return np.where(found & (at < last), at, -1)

    def bits(self, grams: WordGrams) -> np.ndarray:
        """Bits of every character of the distinct words."""
        out = np.empty(grams.grams.shape[1])
        todo, spent = np.arange(len(out)), np.zeros(len(out))
        for k in reversed(range(grams.grams.shape[0])):
            deep = grams.depth[todo] > k
            at = np.where(deep, self.find(grams.grams[k][todo]), -1)
            known = at >= 0
            known[known] = ~np.isnan(self.prob[at[known]])
            out[todo[known]] = -spent[known] - self.prob[at[known]]
            todo, spent, deep = todo[~known], spent[~known], deep[~known]
            if k:
                # the context's weight, if it was ever one
                ctx = np.where(deep, self.find(grams.contexts[k][todo]), -1)
                spent = spent + np.where(ctx >= 0, self.weight[ctx], 0.0)
        out[todo] = -spent - self.unseen
        return out


@dataclass
class LanguageModel:
    """All languages, and the calibration of scores and rejection."""

    names: list[str] = field(default_factory=list)
    models: list[KneserNey] = field(default_factory=list)
    slope: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    #: per language: mean bits per character, their deviation per character, and the limit in standard errors
    usual: np.ndarray = field(default_factory=lambda: np.zeros((0, 3)))

    def measure(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy per character (texts, languages) and number of
        characters, closing marks included."""
        grams = WordGrams(col)
        code, rows = grams.code, grams.rows
        first = np.searchsorted(grams.owner, np.arange(grams.count))

        def by_text(values: np.ndarray) -> np.ndarray:
            total = np.concatenate([[0.0], np.cumsum(values[code])])
            return total[rows[1:]] - total[rows[:-1]]

        n = by_text(np.bincount(grams.owner, minlength=grams.count).astype(float))
        bits = [m.bits(grams) for m in self.models]
        sums = [by_text(np.add.reduceat(b, first) if grams.count else np.zeros(0)) for b in bits]
        entropy = np.stack(sums, 1) / np.maximum(n, 1)[:, None]
        return entropy, n

    def choose(self, col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its bits per character, the margin to the second
        language, and the number of characters."""
        entropy, n = self.measure(col)
        best = entropy.argmin(1)
        low = entropy[np.arange(len(best)), best]
        rest = entropy.copy()
        rest[np.arange(len(best)), best] = np.inf
        margin = rest.min(1) - low if len(self.names) > 1 else np.ones(len(best))
        return best, low, margin, n

    def score(self, margin: np.ndarray, n: np.ndarray) -> np.ndarray:
        z = self.slope[0] + self.slope[1] * np.log1p(margin * np.sqrt(n))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def rejects(self, best: np.ndarray, low: np.ndarray, n: np.ndarray, score: np.ndarray) -> np.ndarray:
        mean, spread, limit = self.usual[best].T
        return ((low - mean) * np.sqrt(np.maximum(n, 1)) > limit * spread) | (score < 0.5)

    def calibrate(self, col: pa.Array, langs: list[str]) -> "LanguageModel":
        best, low, margin, n = self.choose(col)
        right = np.array([self.names[k] == v for k, v in zip(best.tolist(), langs)])
        use = n > 0
        best, low, margin, n, right = (x[use] for x in (best, low, margin, n, right))
        # logistic regression by Newton steps; two made-up rows keep it finite
        x = np.concatenate([np.log1p(margin * np.sqrt(n)), [0.0, 4.0]])
        x = np.stack([np.ones(len(x)), x], 1)
        y = np.concatenate([right.astype(float), [0.0, 1.0]])
        w = np.array([0.0, 1.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), x.T @ (p - y) + 0.01 * (w - [0.0, 1.0]))
        self.slope = np.array([w[0], max(w[1], 1e-3)])
        self.usual = np.tile([np.inf, 1.0, 0.0], (len(self.names), 1))
        for k in range(len(self.names)):
            mine = right & (best == k)
            if mine.any():
                mean = float((low[mine] * n[mine]).sum() / n[mine].sum())
                off = (low[mine] - mean) * np.sqrt(n[mine])
                spread = max(float(np.sqrt(np.mean(off ** 2))), 1e-6)
                self.usual[k] = mean, spread, max(4.0, float(np.quantile(off / spread, 1 - REJECT)) * 1.25)
        return self


def pieces(b: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PIECE_BYTES`` of column ``text``."""
    _, off = text_bytes(b.column(text))
    a = 0
    while a < b.num_rows:
        z = max(a + 1, int(np.searchsorted(off, off[a] + PIECE_BYTES, "right")) - 1)
        yield b.slice(a, z - a)
        a = z


def fold(id_col: str = "doc_id"):
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS


def training_sample(docs: DataFrame, rows: int = SAMPLE, size: int = SAMPLE_BYTES) -> DataFrame:
    """``doc_id, lang, text`` to learn from, equal texts of a language once.

    A hash of the id picks rows at a rate that gives about the bound; the
    exact bound on rows is then a window over those few.  The rates are one
    row a language, each stated by the texts of that language; they are sent
    to all tasks, so that no text moves for them."""
    known = docs.filter("lang is not null and text is not null and doc_id is not null").filter(fold() != 0)
    known = known.select("doc_id", "lang", "text")
    total = known.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.octet_length("text")).alias("_bytes"))
    share = F.lit(float(size)) / F.count(F.lit(1)).over(Window.partitionBy(F.lit(0)))  # rows: languages
    rate = total.select("lang", F.least(F.lit(1.0), F.lit(1.2 * rows) / F.col("_n"), share / F.greatest(F.col("_bytes"), F.lit(1))).alias("_rate"))
    pick = (F.xxhash64("doc_id").bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(float(1 << 52))).alias("_pick")
    some = known.withColumn("_pick", pick).join(F.broadcast(rate), "lang").filter("_pick < _rate").dropDuplicates(["lang", "text"])
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("_pick", "doc_id"))
    return some.withColumn("_nth", nth).filter(F.col("_nth") <= rows).select("doc_id", "lang", "text")


def train(docs: DataFrame, rows: int = SAMPLE, size: int = SAMPLE_BYTES) -> LanguageModel:
    """Models of all languages of ``docs`` and their calibration."""
    sample = stored(training_sample(docs, rows, size), "langid-sample")
    held = F.floor(F.crc32(F.col("doc_id").cast("string").cast("binary")) / FOLDS) % 8 == 0
    model = LanguageModel()
    got = kneser_ney(gram_counts(sample.filter(~held))).toArrow().combine_chunks()
    names = sorted(set(got.column("lang").unique().to_pylist()))
    lang = pc.index_in(got.column("lang"), pa.array(names, pa.string())).to_numpy()
    order, gram = got.column("k").to_numpy(), got.column("gram").to_numpy().view(U64)
    prob, weight = got.column("prob").to_numpy().astype(float), got.column("weight").to_numpy().astype(float)
    for k, name in enumerate(names):
        mine = lang == k
        empty = mine & (order == 0)
        if not empty.any() or np.isnan(prob[empty][0]):
            continue
        use = mine & (order > 0)
        model.names.append(name)
        model.models.append(KneserNey.of(gram[use], prob[use], weight[use], float(prob[empty][0] * weight[empty][0])))
    if model.names:
        rest = sample.filter(held).select("lang", "text").toArrow().combine_chunks()
        model.calibrate(rest.column("text").combine_chunks(), rest.column("lang").to_pylist())
    return model


def with_language(df: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep`` of every row and ``lang_pred, score, bits_per_char,
    rejected``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    spoken = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = df.select(F.col(text_col).alias("_text"), spoken.alias("_spoken"), *keep)
    out = df.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits_per_char"),
                    F.lit(True).alias("rejected")).schema

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            for s in pieces(b, 0):
                spoken = s.column(1).to_numpy(zero_copy_only=False).astype(bool)
                if m.names:
                    best, low, margin, n = m.choose(s.column(0))
                    score = m.score(margin, n)
                    no = m.rejects(best, low, n, score) | ~spoken
                    names = np.array(m.names, object)[best]
                else:
                    spoken, low, score, no = spoken & False, np.zeros(len(spoken)), np.zeros(len(spoken)), ~spoken | True
                    names = np.full(len(spoken), UNKNOWN, object)
                yield pa.RecordBatch.from_arrays(
                    [*s.columns[2:], pa.array(np.where(spoken, names, UNKNOWN).tolist(), pa.string()), pa.array(np.where(spoken, score, 0.0)),
                     pa.array(np.where(spoken, low, 0.0)), pa.array(no)], [*s.schema.names[2:], "lang_pred", "score", "bits_per_char", "rejected"])

    return rows.mapInArrow(judge, out)


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by models of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    found = with_language(docs, train(docs), ["doc_id"])
    return found.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
