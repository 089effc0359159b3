"""Exact n-gram Jaccard links through parity sketches.

A text's set is the hashes of its distinct 5-word shingles.  Two sets of
sizes a and b link when 100 |A n B| >= 75 |A u B|, which is the same as
|A xor B| <= (a + b) / 7.

**Sketches.**  Every shingle toggles one bit of a very long bit vector, so
the Hamming distance of two vectors is at most the symmetric difference.
The vector is cut into ``pieces(band)`` pieces; a piece is stored as the
XOR of hashes of its set bits.  A differing shingle changes one piece, so
of two linked sets at most D = (a + b) div 7 pieces differ.

**Size bands.**  Sets of up to 256 shingles form band 0, where every
shingle is a piece of its own; band k holds sizes up to ``256 * 2**k``.  A
set is sketched for its own band, and for the band below if a smaller
partner may be there (a partner has at least 3/4 of its size).

**Pigeonhole join.**  Put the non-empty pieces of all sets in one global
order, rarest first: two linked sets agree on a piece among the first
D + 1 of both.  Piece frequencies come from one shuffle of (piece, class);
pieces of a single class never leave it, and a set whose first D + 1
pieces are all its own has no partner.  Of the pieces that the same classes
hold, one is joined.

**Pairs.**  Equal sets are one class from the start.  In a group of
classes that share a piece, all are first compared with the group's
smallest class.  After these links are joined to components, those outside
a group's largest component are compared with ``CENTRES`` members of it,
``ROUNDS`` times.  At last every pair of *different* components within a
group is compared.  So a large group of near copies costs a few
comparisons a member, not a square, and no link that could join two
components is left out.  A candidate must pass the size bound and the
Hamming bound on 512 bits of both inside the join, then the Hamming bound
on a sketch as long as the sets, then the exact count on both sets.

**Link counts.**  ``link_counts`` gives every class its number of linked
classes, which the comparisons above do not need: the members of a component
are dealt into blocks of ``BLOCK_SHINGLES`` shingles, every two blocks of a
component meet in one task, and the exact intersections of all their sets
are counted there as a matrix product.  No pair is emitted, and links lie
inside components, so no link is left out.

Defined cases: null and empty texts and texts without words have size 0
and link with nothing (their component is their own id); repeated rows are
equal sets; null ids never become a component id unless all ids of the
component are null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.llm.common import U64, mix64, partitions, running_sum, stored, table
from commitlens.llm.graph import components
from commitlens.llm.textkit import shingle_sets

FIRST = 256
WORDS = 5
#: Shingles a piece holds on average in the largest sets of a band.
PER_PIECE = 2.2
#: Members of the largest component that the rest of a group meets a round.
CENTRES, ROUNDS = 6, 2
#: Pieces that a piece remembers, so that a pair is not taken at each of many.
BEFORE = 16
#: Shingles of the sets of a block, and of a slice of the block's incidence matrix.
BLOCK_SHINGLES, SLICE = 1 << 17, 1 << 12
_SALT = U64(0x5851F42D4C957F2D)


def band(n: int) -> int:
    return 0 if n <= FIRST else (n - 1).bit_length() - 8


def top(k: int) -> int:
    return FIRST << k


def low_band(n: int) -> int:
    """The band below, if a partner of 3/4 of the size may be there; else -1."""
    k = band(n)
    return k - 1 if k and band(-(-3 * n // 4)) < k else -1


def prefix(n: int, k: int) -> int:
    """D + 1 for partners within band ``k``."""
    largest = min(4 * n // 3, top(k)) if k == band(n) else top(k)
    return (n + largest) // 7 + 1


def piece_keys(shingles: np.ndarray, k: int) -> np.ndarray:
    """Keys of the non-empty pieces of one set in band ``k``."""
    if k == 0:
        return mix64(shingles ^ _SALT)
    pieces = int(top(k) / PER_PIECE)
    at = (shingles >> U64(20)) % U64(pieces)
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    words = np.bitwise_xor.reduceat(mix64(shingles)[order], first)
    words, at = words[words != 0], at[first][words != 0]
    with np.errstate(over="ignore"):
        return mix64(words ^ mix64(at + U64(k) * U64(1 << 40)))


def short_sketch(shingles: np.ndarray, k: int) -> bytes:
    bits = 2 * top(k)
    odd = np.bincount((shingles % U64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def class_of(shingles: np.ndarray) -> int | None:
    """Signed 64-bit digest of the whole set; None for the empty set."""
    if not len(shingles):
        return None
    with np.errstate(over="ignore"):
        return int(mix64(np.array([np.sum(mix64(shingles ^ U64(77)), dtype=U64) + U64(len(shingles))])).view(np.int64)[0])


def _rows(batches: Iterable[pa.RecordBatch], step: int = 512) -> Iterator[tuple[pa.Array, Iterator[np.ndarray]]]:
    for b in batches:
        for a in range(0, b.num_rows, step):
            s = b.slice(a, step)
            yield s.column(0), shingle_sets(s.column(1), WORDS)


FOLDS = [f"b{i}" for i in range(8)]
_INFO = "doc_id long, cls long, n int, own_spare int, low_spare int, " + ", ".join(
    f"{b} long" for b in FOLDS)
_MEMBER = ["cls", "n", *FOLDS]


def may_link(x: str, y: str) -> str:
    """SQL: size bound and Hamming bound on 512 bits, for prefixes x and y."""
    bits = " + ".join(f"bit_count({x}{b} ^ {y}{b})" for b in FOLDS)
    return f"4 * least({x}n, {y}n) >= 3 * greatest({x}n, {y}n) and 7 * ({bits}) <= {x}n + {y}n"


def _describe(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, sets in _rows(batches):
        out: list[list] = [[] for _ in range(4)]
        folds = []
        for s in sets:
            n = len(s)
            k, low = band(n), low_band(n)
            row = (class_of(s), n, len(piece_keys(s, k)) - prefix(n, k) if n else 0,
                   len(piece_keys(s, low)) - prefix(n, low) if low >= 0 else 0)
            for col, v in zip(out, row):
                col.append(v)
            folds.append(np.packbits((np.bincount((s % U64(512)).astype(np.int64), minlength=512) & 1).astype(bool)).view(np.int64))
        folds = np.array(folds, np.int64).reshape(-1, 8)
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), pa.array(out[0], pa.int64()), *(pa.array(c, pa.int32()) for c in out[1:]),
             *(pa.array(folds[:, i]) for i in range(8))],
            ["doc_id", "cls", "n", "own_spare", "low_spare", *FOLDS])


def _pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, cls, low of every piece, once per class and task."""
    met: set[int] = set()
    for _, sets in _rows(batches):
        keys, cls, low = [], [], []
        for s in sets:
            c = class_of(s)
            if c is None or c in met:
                continue
            met.add(c)
            n = len(s)
            for is_low, k in ((False, band(n)), (True, low_band(n))):
                if k >= 0:
                    got = piece_keys(s, k)
                    keys.append(got)
                    cls.append(np.full(len(got), c, np.int64))
                    low.append(np.full(len(got), is_low))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(cls)),
                                              pa.array(np.concatenate(low))], ["key", "cls", "low"])


_SETS = "cls long, shingles binary, own binary, low binary"


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every set, and its sketches for its own band and the one below."""
    for _, sets in _rows(batches):
        kept = [s for s in sets if len(s)]
        low = [low_band(len(s)) for s in kept]
        yield pa.RecordBatch.from_arrays(
            [pa.array([class_of(s) for s in kept], pa.int64()), pa.array([s.tobytes() for s in kept], pa.binary()),
             pa.array([short_sketch(s, band(len(s))) for s in kept], pa.binary()),
             pa.array([short_sketch(s, k) if k >= 0 else None for s, k in zip(kept, low)], pa.binary())], ["cls", "shingles", "own", "low"])


def _near_sketches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """a, b of the pairs whose sketches differ in at most (n_a + n_b) / 7 bits."""
    for b in batches:
        keep = []
        na, nb = b.column(2).to_numpy(), b.column(3).to_numpy()
        for i, (x, y) in enumerate(zip(b.column(4), b.column(5))):
            u, v = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
            if 7 * int(np.bitwise_count(u ^ v).sum()) <= int(na[i]) + int(nb[i]):
                keep.append(i)
        yield b.select([0, 1]).take(pa.array(keep, pa.int64()))


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = []
        for i, (x, y) in enumerate(zip(b.column(2), b.column(3))):
            u, v = np.frombuffer(x.as_buffer(), U64), np.frombuffer(y.as_buffer(), U64)
            at = np.searchsorted(u, v)
            both = int((u[np.minimum(at, len(u) - 1)] == v).sum())
            if 100 * both >= 75 * (len(u) + len(v) - both):
                keep.append(i)
        yield b.select([0, 1]).take(pa.array(keep, pa.int64()))


def count_links(a: list[np.ndarray], b: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many sets of ``b`` each set of ``a`` links with, and the other
    way round; without ``b``: how many other sets of ``a``."""
    sets = a + (b or [])
    size = np.array([len(x) for x in sets], np.int64)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(code) > 1
    place = np.cumsum(often) - 1  # shingles of one set alone are in no intersection
    row = np.repeat(np.arange(len(sets)), size)[often[code]]
    col = place[code[often[code]]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    n = len(a)
    both = np.zeros((n, len(sets) - n if b is not None else n), np.float32)
    for at in range(0, int(often.sum()), SLICE):
        lo, hi = np.searchsorted(col, (at, at + SLICE))
        m = np.zeros((len(sets), SLICE), np.float32)
        m[row[lo:hi], col[lo:hi] - at] = 1
        both += m[:n] @ (m[n:] if b is not None else m).T
    na, nb = size[:n, None], (size[n:] if b is not None else size)[None, :]
    linked = 100 * both.astype(np.int64) >= 75 * (na + nb - both.astype(np.int64))
    if b is None:
        np.fill_diagonal(linked, False)
    return linked.sum(1), linked.sum(0)


def _count_block_pair(pdf: pd.DataFrame) -> pd.DataFrame:
    """cls, n_links inside one pair of blocks (``i`` and ``j``)."""
    sets = [np.frombuffer(x, U64) for x in pdf["shingles"]]
    i, j = int(pdf["i"].iloc[0]), int(pdf["j"].iloc[0])
    if i == j:
        return pd.DataFrame({"cls": pdf["cls"], "n_links": count_links(sets)[0]})
    first = (pdf["block"] == i).to_numpy()
    if first.all() or not first.any():
        return pd.DataFrame({"cls": pdf["cls"][:0], "n_links": np.zeros(0, np.int64)})
    a, b = count_links([s for s, f in zip(sets, first) if f], [s for s, f in zip(sets, first) if not f])
    return pd.DataFrame({"cls": np.concatenate([pdf["cls"][first], pdf["cls"][~first]]), "n_links": np.concatenate([a, b])})


class JaccardJoin:
    """The join's steps over one table of ``id`` and ``text``."""

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        self.docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        self.info = stored(self.docs.mapInArrow(_describe, _INFO), "sets")
        self.classes = stored(self.info.filter("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("own_spare").alias("own_spare"),
            F.first("low_spare").alias("low_spare"), *(F.first(b).alias(b) for b in FOLDS)), "classes")
        self._found: tuple[DataFrame, DataFrame] | None = None

    def candidates(self) -> tuple[DataFrame, DataFrame]:
        """The shared pieces, and the sets of the classes that hold one
        (``_SETS``), stored once for all comparisons."""
        if self._found is None:
            shared = self.shared_pieces()
            self._found = shared, stored(self._sets_of(shared.select("cls").distinct()), "shingles")
        return self._found

    def shared_pieces(self) -> DataFrame:
        """key, cls: the first D + 1 pieces of every class, rarest first,
        as far as another class has them too; ``before``: the class's
        ``BEFORE`` pieces before this one."""
        n_parts = partitions(self.docs.sparkSession)
        keys = self.docs.select("doc_id", "text").mapInArrow(_pieces, "key long, cls long, low boolean").repartition(n_parts, "key")
        w = Window.partitionBy("key")
        common = keys.select("*", F.count("cls").over(w).alias("df"), F.min("cls").over(w).alias("_a"),
                             F.max("cls").over(w).alias("_b")).filter("_a <> _b")
        lists = common.groupBy("cls", "low").agg(F.sort_array(F.collect_set(F.struct("df", "key"))).alias("ks"))

        # a class's own pieces come first in the order: of D + 1, they leave _take
        rows = lists.join(self.classes.select(*_MEMBER, "own_spare", "low_spare"), "cls")
        rows = rows.withColumn("_take", F.size("ks") - F.when(F.col("low"), F.col("low_spare")).otherwise(F.col("own_spare")))
        first = rows.filter("_take > 0").select(*_MEMBER, "low", F.explode(F.slice("ks", F.lit(1), F.least("_take", F.size("ks")))).alias("k"))
        rows = stored(first.select("k.key", "k.df", "low", *_MEMBER), "pieces")
        # a passage gives many pieces with the same members: one of them tells as much
        signed = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c"), *(F.sum(F.xxhash64("cls", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}")
                                                                         for i in (0, 1)))
        one = signed.filter("c > 1").groupBy("c", "s0", "s1").agg(F.min("key").alias("key"))
        before = Window.partitionBy("cls", "low").orderBy("df", "key").rowsBetween(-BEFORE, -1)
        kept = rows.join(one.select("key"), "key", "left_semi").withColumn("before", F.collect_list("key").over(before))
        return stored(kept.select("key", "before", *_MEMBER), "pieces")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) of classes that link."""
        sets = self.candidates()[1]

        def side(c: str) -> DataFrame:
            return sets.select(F.col("cls").alias(c), F.expr("octet_length(shingles) div 8").cast("int").alias(f"n{c}"),
                               F.col("own").alias(f"own{c}"), F.col("low").alias(f"low{c}"))

        both = pairs.join(side("a"), "a").join(side("b"), "b")

        def sketch(mine: str, other: str) -> Column:
            return F.when(F.length(f"own{mine}") <= F.length(f"own{other}"), F.col(f"own{mine}")).otherwise(F.col(f"low{mine}"))

        both = both.select("a", "b", "na", "nb", sketch("a", "b").alias("sa"), sketch("b", "a").alias("sb")).filter(
            "sa is not null and sb is not null and length(sa) = length(sb)")
        near = stored(both.mapInArrow(_near_sketches, "a long, b long"), "near")
        full = (near.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa")), "a")
                .join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb"))
        return full.mapInArrow(_linked, "a long, b long")

    def _sets_of(self, classes: DataFrame) -> DataFrame:
        """``_SETS`` of the classes in ``classes`` (column ``cls``)."""
        need = classes.join(self.classes.select("cls", "doc_id"), "cls")
        texts = self.docs.join(need.select(F.col("doc_id").alias("_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        sets = texts.mapInArrow(_sets, _SETS).dropDuplicates(["cls"])
        return sets.join(need.select("cls"), "cls", "left_semi")

    def link_counts(self, roots: DataFrame, block: int = BLOCK_SHINGLES) -> DataFrame:
        """cls, n_links of every class that links with another one;
        ``roots``: ``components`` of the links."""
        ends = roots.select(F.col("root").alias("cls")).distinct()
        members = roots.select(F.col("node").alias("cls"), "root").unionByName(ends.withColumn("root", F.col("cls")))
        members = members.join(self.classes.select("cls", F.col("n").cast("long").alias("n")), "cls")
        dealt = running_sum(members, ["root"], [F.col("cls")], "n", "at").withColumn("block", F.expr(f"at div {block}"))
        last = dealt.groupBy("root").agg(F.max("block").alias("last"))
        pairs = dealt.join(last, "root").withColumn("other", F.explode(F.expr("sequence(0L, last)")))
        pairs = pairs.select("cls", "root", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        sets = self.candidates()[1].select("cls", "shingles")
        found = pairs.join(sets, "cls").groupBy("root", "i", "j").applyInPandas(_count_block_pair, "cls long, n_links long")
        return found.groupBy("cls").agg(F.sum("n_links").alias("n_links"))

    def links(self) -> DataFrame:
        """Class pairs ``u, v`` that link: enough of them to join every
        component."""
        shared = self.candidates()[0]
        centre = shared.groupBy("key").agg(F.min(F.struct(*_MEMBER)).alias("c"))
        star = shared.join(centre, "key").filter("cls <> c.cls and " + may_link("", "c."))
        links = stored(self.verified(star.select(F.col("c.cls").alias("a"), F.col("cls").alias("b")).distinct()), "links")
        for turn in range(ROUNDS):
            mixed = self._mixed(shared, links)
            count = mixed.groupBy("key", "root").agg(F.count("cls").alias("c"))
            main = count.groupBy("key").agg(F.max_by("root", F.struct("c", "root")).alias("main"))
            seen = mixed.join(main, "key")
            few = [F.min(F.struct(F.xxhash64("cls", F.lit(turn * CENTRES + i)).alias("h"), *_MEMBER)).alias(f"c{i}") for i in range(CENTRES)]
            centres = seen.filter("root = main").groupBy("key").agg(*few).select("key", F.array_distinct(F.array(
                *(f"c{i}" for i in range(CENTRES)))).alias("cs"))
            tried = (seen.filter("root <> main").join(centres.select("key", F.explode("cs").alias("c")), "key")
                     .filter(may_link("", "c.")).select(F.least("cls", "c.cls").alias("a"), F.greatest("cls", "c.cls").alias("b")))
            links = stored(links.union(self.verified(tried.distinct())), "links")
        mixed = self._mixed(shared, links)
        x, y = mixed.alias("x"), mixed.alias("y")
        # a pair is taken at its first common piece; at later ones a piece before mostly is common too
        across = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.cls") < F.col("y.cls"))
                        & (F.col("x.root") != F.col("y.root")) & ~F.arrays_overlap("x.before", "y.before")
                        & F.expr(may_link("x.", "y.")))
        rest = self.verified(across.select(F.col("x.cls").alias("a"), F.col("y.cls").alias("b")).distinct())
        return stored(links.union(rest), "links").select(F.col("a").alias("u"), F.col("b").alias("v"))

    def _mixed(self, shared: DataFrame, links: DataFrame) -> DataFrame:
        """Members, with their component's root, of the pieces that more
        than one component holds."""
        roots = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
        named = shared.join(roots, F.col("cls") == F.col("node"), "left").select(
            "key", "before", *_MEMBER, F.coalesce("root", "cls").alias("root"))
        ends = named.groupBy("key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).filter("_a <> _b").select("key")
        return stored(named.join(ends, "key", "left_semi"), "mixed")

    def members(self, count: bool = False) -> DataFrame:
        """doc_id, n_shingles, class_id, component_id of every row, and with
        ``count`` n_links, the number of other sets that its set links with."""
        roots = components(self.links())
        named = self.classes.select("cls", "doc_id").join(roots, F.col("cls") == F.col("node"), "left").select(
            "cls", "doc_id", F.coalesce("root", "cls").alias("root"))
        least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        named = named.join(least, "root").select("cls", "component_id")
        rows = self.info.select("doc_id", "cls", F.col("n").cast("long").alias("n_shingles")).join(named, "cls", "left")
        cols = ["doc_id", "n_shingles", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"), F.col("cls").alias("class_id")]
        if not count:
            return rows.select(*cols)
        return rows.join(self.link_counts(roots), "cls", "left").select(*cols, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


    def representatives(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` (the joined table) without near copies: of each
        component those of its smallest id, and all empty sets.  Rows that
        repeat an id and its text count as one; rows that repeat an id with
        another text stay or go with it."""
        keep = self.members().filter("n_shingles = 0 or doc_id <=> component_id").select(F.col("doc_id").alias("_id")).distinct()
        rows = df.join(keep, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
        return rows.dropDuplicates(["doc_id", "text"])


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the component of their five-word shingle set and
    the number of other sets that it links with."""
    return JaccardJoin(table(spark, sf_dir, "documents")).members(count=True)
