"""Token ids in directly addressable codes (DAC).

Every id is cut into 8-bit chunks, lowest first.  Level 0 holds the lowest
chunk of every id and a bitmap that tells which ids go on; level 1 holds
the next chunk of those, and so on.  A rank directory (one 32-bit count
per 512 bits) turns a position at one level into the position at the next
one in constant time, so any id can be read alone, without decoding its
block.

File format.  A token file is a Parquet data set with one row per segment:
``part, seg`` (order), ``part_start`` (ids before the segment in its part),
``doc_ids``, ``ends`` (running id count after each document) and ``dac``,
the segment's codes (see ``encode``).  Segments are written by the task
that holds a contiguous range of document ids, through Spark's own
committer: a lost executor's segments are written again by another.

Defined cases: null texts are empty (only the end id), null ids sort first,
repeated ids stay separate, an empty table gives no rows, other columns
are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import range_parts, running_start, table
from commitlens.session import scratch_path

MAGIC = b"DAC1"
RANK_BITS = 512
SEGMENT_IDS = 1 << 18
#: Words whose ids one Python worker remembers.
WORD_CACHE = 600_000


def encode(ids: np.ndarray) -> bytes:
    """Header (magic, id count, level count), then for each level its entry
    count, chunks, bitmap bytes and rank directory."""
    rest = np.asarray(ids, np.uint32)
    levels = []
    while True:
        more = rest >> np.uint32(8)
        goes = more > 0
        bits = np.packbits(goes, bitorder="little")
        block = np.add.reduceat(goes, np.arange(0, len(goes), RANK_BITS), dtype=np.uint32) if len(goes) else np.zeros(0, np.uint32)
        rank = np.concatenate([[0], np.cumsum(block)[:-1]]).astype("<u4") if len(block) else block.astype("<u4")
        levels.append(struct.pack("<Q", len(rest)) + (rest & np.uint32(255)).astype(np.uint8).tobytes() + bits.tobytes() + rank.tobytes())
        rest = more[goes]
        if not len(rest):
            return MAGIC + struct.pack("<QB", len(ids), len(levels)) + b"".join(levels)


class Codes:
    """Read access to one encoded segment."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a DAC segment")
        self.n, depth = struct.unpack_from("<QB", blob, 4)
        at, self.levels = 13, []
        for _ in range(depth):
            (n,) = struct.unpack_from("<Q", blob, at)
            at += 8
            chunks = np.frombuffer(blob, np.uint8, n, at)
            at += n
            bits = np.frombuffer(blob, np.uint8, -(-n // 8), at)
            at += len(bits)
            rank = np.frombuffer(blob, "<u4", -(-n // RANK_BITS), at)
            at += rank.nbytes
            self.levels.append((chunks, bits, rank))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        """One id: a chunk, a bit and a rank at each of its levels."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k, (chunks, bits, rank) in enumerate(self.levels):
            value |= int(chunks[i]) << 8 * k
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            before = np.unpackbits(bits[block * RANK_BITS // 8: (i >> 3) + 1], bitorder="little")
            i = int(rank[block]) + int(before[: i - block * RANK_BITS].sum())
        return value

    def all(self) -> np.ndarray:
        out = np.zeros(self.n, np.uint32)
        at = np.arange(self.n)
        for k, (chunks, bits, _) in enumerate(self.levels):
            out[at] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            at = at[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


class _Numbered(dict):
    """Numbers words as they are asked for; ``new``: those of late."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class WordEncoder:
    """Whole texts through the tokenizers library, one word at a time.

    The byte-level pre-tokeniser never joins characters across the places
    where this pattern cuts: before a blank, inside a run of blanks where
    the pre-tokeniser cuts as well, and between a letter and punctuation
    other than an apostrophe.  So the ids of a text are those of its words,
    and a word met before need not be encoded again.  A word of letters is
    one pre-token, for which the library's BPE model is asked directly.
    Texts with the control characters 0x1C-0x1F, on which the two blank
    classes differ, or with the content of an added token are encoded in one
    go.  ``literal``: special tokens in a text are plain characters; without
    it, as by the library's default, they get their own ids.
    """

    LETTER = "[a-zA-ZÀ-ÖØ-öø-ÿ]"
    CUT = re.compile(rf"\s+(?!\S)| ?{LETTER}+(?![^\s.,;:!?|%$&*#()\[\]])| ?\S+|\s+")
    PLAIN = re.compile(f" ?{LETTER}+")
    ODD = "[\x1c-\x1f]"

    def __init__(self, path: str, literal: bool = True):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = literal
        added = [t.content for t in self.tok.get_added_tokens_decoder().values() if t.content]
        self.odd = re.compile("|".join([self.ODD, *map(re.escape, added)]))
        # the byte-level alphabet: printable Latin-1 stands for itself
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}
        self.clear()

    def _ids(self, word: str) -> list[int]:
        if self.PLAIN.fullmatch(word):
            if word.isascii():
                return [t.id for t in self.tok.model.tokenize(word.replace(" ", self.alphabet[32]))]
            return [t.id for t in self.tok.model.tokenize(word.encode().decode("latin-1").translate(self.alphabet))]
        return self.tok.encode(word, add_special_tokens=False).ids

    def clear(self) -> None:
        self.known = _Numbered()
        self.ids = np.empty(1 << 20, np.uint32)  # ids of all known words, side by side
        self.first = np.zeros(1 << 16, np.int64)

    def _learn(self) -> None:
        """Ids of the words that were numbered since the last call."""
        words, self.known.new = self.known.new, []
        if not words:
            return
        got = [self._ids(w) for w in words]
        n = len(self.known) - len(words)
        while n + len(words) + 1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
        at = self.first[n] + np.cumsum([len(g) for g in got])
        while at[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.first[n]:at[-1]] = list(chain.from_iterable(got))
        self.first[n + 1:n + 1 + len(words)] = at

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) > WORD_CACHE:
            self.clear()
        odd = {i: self.tok.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts) if self.odd.search(t)}
        cut = [[] if i in odd else self.CUT.findall(t) for i, t in enumerate(texts)]
        count = np.cumsum([0, *map(len, cut)])
        code = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, count[-1])
        self._learn()
        begin = self.first[code]
        n = self.first[code + 1] - begin
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = self.ids[np.repeat(begin - ends[:-1], n) + np.arange(ends[-1])]
        at = ends[count]
        for i, (a, b) in enumerate(zip(at[:-1], at[1:])):
            yield np.array(odd[i], np.uint32) if i in odd else flat[a:b]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder; what it has learned serves its later tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path, literal=False)
    return _encoders[path]


_SCHEMA = "part int, seg int, part_start long, n_ids long, doc_ids array<bigint>, ends array<bigint>, dac binary"


def _slices(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[tuple[list, list[str], int]]:
    for b in batches:
        for a in range(0, b.num_rows, rows):
            s = b.slice(a, rows)
            yield s.column(0).to_pylist(), [t or "" for t in s.column(1).to_pylist()], s.column(2)[0].as_py()


def write_tokens(df: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every text and write the token file in ascending id order."""
    docs = range_parts(df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "doc_id")
    docs = docs.sortWithinPartitions("doc_id")

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([end_id], np.uint32)
        seg = start = held = 0
        ids: list[np.ndarray] = []
        doc_ids: list = []
        ends: list[int] = []
        part = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "seg": pa.array([seg], pa.int32()),
                "part_start": [start], "n_ids": [held],
                "doc_ids": pa.array([doc_ids], pa.list_(pa.int64())), "ends": pa.array([ends], pa.list_(pa.int64())),
                "dac": pa.array([encode(np.concatenate(ids))], pa.binary())})

        for keys, texts, part in _slices(batches):
            for key, out in zip(keys, enc.batch(texts)):
                ids += [out, end]
                held += len(out) + 1
                doc_ids.append(key)
                ends.append(held)
                if held >= SEGMENT_IDS:
                    yield flush()
                    seg, start, held = seg + 1, start + held, 0
                    ids, doc_ids, ends = [], [], []
        if doc_ids:
            yield flush()

    docs.mapInArrow(segments, _SCHEMA).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document of a token file, in file order: id, start, n_tokens,
    ids_crc32 -- decoded from the codes."""
    segs = spark.read.schema(_SCHEMA).parquet(path)
    # one row per part, that is per shuffle partition of the writer
    totals = segs.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    starts = running_start(totals.withColumn("_all", F.lit(0)), "part", "_n", ["_all"]).drop("_all")

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                ids = Codes(b.column(3)[i].as_py()).all().astype("<u4")
                ends = np.array(b.column(2)[i].as_py(), np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(b.column(1)[i].as_py(), pa.int64()),
                    "start": begins + b.column(0)[i].as_py(), "n_tokens": ends - begins,
                    "ids_crc32": pa.array([zlib.crc32(ids[x:y].tobytes()) for x, y in zip(begins, ends)], pa.int64())})

    return (segs.join(F.broadcast(starts), "part").select((F.col("_start") + F.col("part_start")).alias("at"), "doc_ids", "ends", "dac")
            .mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_at(spark: SparkSession, path: str, positions: list[int]) -> DataFrame:
    """``position, id`` of single tokens of a token file, by their place
    over all documents: only the segments that hold one are read, and of
    these a chunk, a bit and a rank per level, no block.  Positions beyond
    the file give no row; repeated ones one."""
    segs = spark.read.schema(_SCHEMA).parquet(path)
    totals = segs.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    starts = running_start(totals.withColumn("_all", F.lit(0)), "part", "_n", ["_all"]).drop("_all")
    wanted = sorted({int(p) for p in positions if p >= 0})

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = np.array(wanted, np.int64)
        for b in batches:
            for at, n, dac in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                here = asked[np.searchsorted(asked, at):np.searchsorted(asked, at + n)]
                codes = Codes(dac.as_py())
                yield pa.RecordBatch.from_pydict({"position": here, "id": pa.array([codes[int(p) - at] for p in here], pa.int64())})

    placed = segs.join(F.broadcast(starts), "part").select((F.col("_start") + F.col("part_start")).alias("at"), "n_ids", "dac")
    some = F.exists(F.array(*[F.lit(p).cast("long") for p in wanted]), lambda p: (p >= F.col("at")) & (p < F.col("at") + F.col("n_ids")))
    return placed.filter(some if wanted else F.lit(False)).mapInArrow(read, "position long, id long")


def op8_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    """All documents written to a token file and read back from it."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    path = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer)
    return read_tokens(spark, path)
