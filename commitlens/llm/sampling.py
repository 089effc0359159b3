"""Sampled subword segmentations by forward filtering, backward sampling.

A text is written in the model's alphabet (one space mark before the text,
spaces as space marks) and every piece of the vocabulary that matches
somewhere is an edge of its lattice.  Characters that no piece covers, and
literal space marks, become their byte pieces, so decoding gives the text
back exactly.  A path's weight is the product of its pieces' weights,
``(rank + RANK_SHIFT) ** -1`` by merge rank, to the power ``theta``.

Forward filtering sums the weights of all paths to every position;
backward sampling then walks from the end and picks each incoming edge
with its exact probability given the sum.  The random numbers are a hash
of (seed, row key, word number, step), so a text's segmentation depends on
nothing but its key: not on partitions, retries or other rows.

No piece crosses a space mark that follows another character, or a line
break, so the lattice is a chain of independent word lattices.  The
filtered lattice of a word is kept for its next occurrence, and the
backward steps of all words of a batch are taken together with numpy.

Defined cases: a null text is empty and has no pieces; a null key counts
as -1; repeated rows get equal segmentations; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import U64, mix64, table

MARK = "▁"
RANK_SHIFT = 20.0
#: Lattice edges one Python worker remembers before it starts anew.
EDGE_CACHE = 2_000_000


_STEP = U64(0xD1342543DE82EF95)
_BITS = 18


def _hash(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_STEP) + ord(c)) & (1 << 64) - 1
    return h


class PieceModel:
    """Pieces and weights of a SentencePiece model file."""

    WORD = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.plain = {p: i for i, p in enumerate(self.pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.plain):
            raise ValueError("a piece crosses the places where words are cut")
        self.longest = max(map(len, self.plain))
        rank = {i: -sp.get_score(i) for i in self.plain.values()}
        self.log_weight = {i: -float(np.log((r if r < n else n) + RANK_SHIFT)) for i, r in rank.items()}
        self.byte_weight = -float(np.log(n + RANK_SHIFT)) - 2.0

        self.weight = np.array([self.log_weight.get(i, 0.0) for i in range(n)])
        # every beginning of a piece by its hash: the piece's id, or -1
        table = {p[:k]: -1 for p in self.plain for k in range(1, len(p) + 1)} | self.plain
        hashes = mix64(np.array([_hash(p) for p in table], U64))
        order = np.argsort(hashes)
        self.hashes, self.found = hashes[order], np.array(list(table.values()), np.int64)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two beginnings of pieces share a hash")
        # first place of every value of the leading bits, and the most places of one
        self.place = np.searchsorted(self.hashes >> U64(64 - _BITS), np.arange((1 << _BITS) + 1, dtype=U64))
        self.crowd = int(np.diff(self.place).max())
        self.place = np.minimum(self.place, len(self.hashes) - 1)
        self.bytes_of = [bytes([int(p[3:5], 16)]) if i in self.byte.values() else p.replace(MARK, " ").encode()
                         for i, p in enumerate(self.pieces)]

    SWAP = str.maketrans({" ": MARK, MARK: " "})

    def spell(self, text: str) -> str:
        """The text in the model's alphabet; a literal mark becomes a space,
        which no piece holds, and so ends up as its bytes."""
        return MARK + (text.translate(self.SWAP) if MARK in text else text.replace(" ", MARK))

    def char_ids(self, char: str) -> list[int]:
        return [self.byte[b] for b in char.translate(self.SWAP).encode()]

    def decode(self, ids: Iterable[int]) -> bytes:
        """UTF-8 of the encoded text."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:]

    def edges(self, codes: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All edges over the code points of some words; ``left``: code
        points from here to the end of the word.  Returns first code point,
        length, id and log weight; id -1 - c stands for the bytes of the
        character c, which no piece covers."""
        at, h, out = np.arange(len(codes)), np.zeros(len(codes), U64), []
        for size in range(1, self.longest + 1):
            with np.errstate(over="ignore"):
                h = h * _STEP + codes[at + size - 1]
            mixed = mix64(h)
            place = self.place[mixed >> U64(64 - _BITS)]
            begins = self.hashes[place] == mixed
            for k in range(1, self.crowd):
                miss = np.flatnonzero(~begins)
                next_ = np.minimum(place[miss] + k, len(self.hashes) - 1)
                hit = self.hashes[next_] == mixed[miss]
                begins[miss[hit]] = True
                place[miss[hit]] = next_[hit]
            got = np.where(begins, self.found[place], -1)
            if size == 1:
                bare = np.flatnonzero(got < 0)
                size_of = {c: len(self.char_ids(chr(c))) for c in np.unique(codes[bare]).tolist()}
                out.append((bare, np.ones(len(bare), np.int64), -1 - codes[bare].astype(np.int64),
                            self.byte_weight * np.array([size_of[c] for c in codes[bare].tolist()], float)))
            hit = np.flatnonzero(got >= 0)
            out.append((at[hit], np.full(len(hit), size), got[hit], self.weight[got[hit]]))
            go = np.flatnonzero(begins & (left[at] > size))
            at, h = at[go], h[go]
        return tuple(np.concatenate(c) for c in zip(*out[::-1]))  # long pieces, the likely ones, first


class _Numbered(dict):
    """Numbers words as they are asked for; ``new``: those of late."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def uniform(seed: int, keys: np.ndarray, word: np.ndarray, step: int) -> np.ndarray:
    """Numbers in [0, 1) that depend on the arguments alone."""
    with np.errstate(over="ignore"):
        x = mix64(mix64(keys ^ U64(seed)) + word.astype(U64) * U64(0x9E3779B97F4A7C15) + U64(step) * U64(0xC2B2AE3D27D4EB4F))
    return (x >> U64(11)).astype(float) * 2.0 ** -53


class Sampler:
    """Filtered word lattices side by side in growing arrays."""

    def __init__(self, model: PieceModel, theta: float = 2.0, seed: int = 0):
        self.model, self.theta, self.seed = model, theta, seed
        self.clear()

    def clear(self) -> None:
        self.known = _Numbered()
        self.base = np.empty(1 << 16, np.int64)  # first node of every known word
        self.nodes = self.edges = 0
        self.first = np.empty(1 << 16, np.int64)  # first edge of every node
        self.cum = np.empty(1 << 18)  # node number + cumulative probability
        self.start, self.ids = np.empty(1 << 18, np.int64), np.empty(1 << 18, np.int64)

    def _append(self, name: str, n: int, new: np.ndarray) -> None:
        have = getattr(self, name)
        if n + len(new) > len(have):
            have = np.concatenate([have, np.empty(len(have) + len(new), have.dtype)])
            setattr(self, name, have)
        have[n:n + len(new)] = new

    def _filter(self, words: list[str]) -> None:
        """Forward filtering of new words, all at once by end position."""
        if not words:
            return
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(U64)
        size = np.fromiter(map(len, words), np.int64, len(words))
        off = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)
        left = np.repeat(off + size, size) - np.arange(len(codes))
        begin, length, ids, weight = self.model.edges(codes, left)
        start = begin + word[begin]  # a word of n characters has n + 1 nodes
        end = start + length
        order = np.argsort(end, kind="stable")
        start, end, ids, score = start[order], end[order], ids[order], self.theta * weight[order]
        nodes = len(codes) + len(words)
        first = np.concatenate([[0], np.cumsum(np.bincount(end, minlength=nodes))[:-1]])
        place = (begin + length - off[word[begin]])[order]  # position in the word
        by_place = np.argsort(place, kind="stable")
        cut = np.searchsorted(place[by_place], np.arange(1, size.max() + 2))
        alpha, cum = np.zeros(nodes), np.empty(len(end))
        for a, b in zip(cut[:-1], cut[1:]):
            e = by_place[a:b]
            seg = np.flatnonzero(np.concatenate([[True], end[e][1:] != end[e][:-1]]))
            x = alpha[start[e]] + score[e]
            high = np.maximum.reduceat(x, seg)
            many = np.diff(np.append(seg, len(e)))
            x = np.exp(x - np.repeat(high, many))
            total = np.add.reduceat(x, seg)
            alpha[end[e][seg]] = high + np.log(total)
            run = np.cumsum(x / np.repeat(total, many))
            cum[e] = run - np.repeat(run[seg] - x[seg] / total, many)
        self._append("base", len(self.known) - len(words), self.nodes + off + np.arange(len(words)))
        for name, have, new in (("first", self.nodes, self.edges + first), ("cum", self.edges, self.nodes + end + cum),
                                ("start", self.edges, self.nodes + start), ("ids", self.edges, ids)):
            self._append(name, have, new)
        self.nodes += nodes
        self.edges += len(end)

    def encode(self, keys: np.ndarray, texts: list[str]) -> list[np.ndarray]:
        """Sampled ids of every text; ``keys``: 64-bit row keys."""
        if self.edges > EDGE_CACHE:
            self.clear()
        cut = [self.model.WORD.findall(self.model.spell(t)) for t in texts]
        words = list(chain.from_iterable(cut))
        code = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        new, self.known.new = self.known.new, []
        self._filter(new)
        base = self.base[code]
        node = base + np.fromiter(map(len, words), np.int64, len(words))
        per_text = np.fromiter(map(len, cut), np.int64, len(cut))
        begin = np.concatenate([[0], np.cumsum(per_text)])
        nth = np.arange(len(words)) - np.repeat(begin[:-1], per_text)
        row_key = np.repeat(keys, per_text)
        cum, start, ids = self.cum[:self.edges], self.start[:self.edges], self.ids[:self.edges]
        first, last = self.first[:self.nodes], np.append(self.first[1:self.nodes], self.edges) - 1
        live, steps = np.arange(len(words)), []
        taken = np.zeros(len(words), np.int64)
        while len(live):
            u = uniform(self.seed, row_key[live], nth[live], len(steps))
            at = node[live]
            edge, aim, more = first[at], at + u, np.arange(len(live))
            while len(more):
                more = more[(cum[edge[more]] <= aim[more]) & (edge[more] < last[at[more]])]
                edge[more] += 1
            steps.append((live, ids[edge]))
            taken[live] += 1
            node[live] = start[edge]
            live = live[node[live] > base[live]]
        at = np.concatenate([[0], np.cumsum(taken)])
        flat = np.empty(at[-1], np.int64)
        for k, (who, got) in enumerate(steps):
            flat[at[who + 1] - 1 - k] = got
        ends = at[begin]
        if (flat < 0).any():
            low = np.flatnonzero(flat < 0)
            spelled = [self.model.char_ids(chr(-1 - c)) for c in flat[low].tolist()]
            size = np.ones(len(flat), np.int64)
            size[low] = list(map(len, spelled))
            grown = np.concatenate([[0], np.cumsum(size)])
            flat = np.repeat(flat, size)
            for a, got in zip(grown[low].tolist(), spelled):
                flat[a:a + len(got)] = got
            ends = grown[ends]
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]


_models: dict[str, PieceModel] = {}
_samplers: dict[tuple, Sampler] = {}


def piece_model(path: str) -> PieceModel:
    """The worker's model, read once."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def word_sampler(path: str, theta: float, seed: int) -> Sampler:
    """The worker's sampler; its lattices serve its later tasks."""
    if (path, theta, seed) not in _samplers:
        _samplers[path, theta, seed] = Sampler(piece_model(path), theta, seed)
    return _samplers[path, theta, seed]


def sample_pieces(df: DataFrame, model_path: str, theta: float = 2.0, seed: int = 0, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every row: one sampled segmentation of its text."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = word_sampler(model_path, theta, seed)
        for b in batches:
            for a in range(0, b.num_rows, 256):
                s = b.slice(a, 256)
                keys = np.array([-1 if k is None else k for k in s.column(0).to_pylist()], np.int64).view(U64)
                got = sampler.encode(keys, [t or "" for t in s.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int32),
                                                           np.concatenate(got).astype(np.int32))], ["doc_id", "ids"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        encode, "doc_id long, ids array<int>")


def decode_pieces(df: DataFrame, model_path: str) -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, text`` of rows ``doc_id, ids``."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(model_path)
        for b in batches:
            for a in range(0, b.num_rows, 256):
                s = b.slice(a, 256)
                got = s.column(1)
                flat, at = got.flatten().to_numpy(), np.concatenate([[0], np.cumsum(got.value_lengths().to_numpy())])
                ids = [flat[x:y] for x, y in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays(
                    [s.column(0), pa.array(np.diff(at)), pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                     pa.array([model.decode(x.tolist()).decode() for x in ids], pa.string())],
                    ["doc_id", "n_pieces", "ids_crc32", "text"])

    return df.select("doc_id", "ids").mapInArrow(decode, "doc_id long, n_pieces long, ids_crc32 long, text string")


def op3_sentencepiece(spark: SparkSession, sf_dir: str, model_path: str | None = None) -> DataFrame:
    """All documents encoded and decoded again; digests of the ids and of
    the decoded text."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path("piece_bpe_32k.model")
    back = decode_pieces(sample_pieces(table(spark, sf_dir, "documents"), model_path), model_path)
    return back.select("doc_id", "n_pieces", "ids_crc32", F.length("text").cast("long").alias("n_chars"),
                       F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
