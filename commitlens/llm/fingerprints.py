"""I-Match fingerprints over randomised lexicon subsets, DataFrame only.

1. Document frequency of every term (one aggregation, combined on the map
   side); the lexicon keeps the terms of a chosen inverse-document-frequency
   band, all of them.  Terms in at least ``min_share * n`` documents are at
   most (mean number of distinct terms of a document) / ``min_share``, which
   does not grow with the number of documents.
2. A text's distinct terms inside the lexicon are sorted, and every one of
   ``SUBSETS`` randomised lexicon subsets -- those terms whose hash has
   certain bits, at rates of 1/2 to 1/256 so that short and long texts both
   find subsets of about one term -- is hashed as a whole.
3. The fingerprint is the list of these hashes; the likeness of two is the
   share of equal ones among the subsets that are not empty in both (1.0
   when all are empty in both).

A text with no term inside the band uses all its terms, so that short
texts are told apart.  Equal texts have equal fingerprints.

Defined cases: null texts are empty; empty texts have the all-zero
fingerprint; repeated ids stay separate rows ordered by id, then text
hash; null ids come first; the next document of the only row is itself; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from commitlens.llm.common import partitions, stored, table

TERM_CUT = r"[^\p{L}\p{N}]+"
CELLS = 1 << 13
#: (rate bits, first bit, subsets): subset ``j`` of a row holds the lexicon
#: terms whose hash has the value ``j`` in those bits, 2 ** -rate of them.
RATES = [(1, 0, 2), (1, 1, 2), (4, 2, 16), (6, 6, 20), (8, 12, 20)]
SUBSETS = [(((1 << r) - 1) << at, j << at) for r, at, n in RATES for j in range(n)]


def term_hashes(text: Column) -> Column:
    """Hashes of the distinct lower-case terms of the whole text."""
    words = F.filter(F.split(F.lower(text), TERM_CUT), lambda w: w != "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(terms: DataFrame, min_share: float, max_share: float) -> DataFrame:
    """One row: the band's term hashes in ``CELLS`` short lists (column
    ``cells``).  ``terms`` has one row per document, column ``terms``."""
    spark = terms.sparkSession
    df = stored(terms.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")), "terms")
    n = terms.count()
    low = max(2, math.ceil(min_share * n))
    high = max(low, math.floor(max_share * n))
    band = df.filter(F.col("df").between(low, high)).groupBy(F.pmod("t", F.lit(CELLS)).alias("cell")).agg(
        F.collect_list("t").alias("ts"))
    cells = (spark.range(CELLS).withColumnRenamed("id", "cell").join(band, "cell", "left")
             .agg(F.transform(F.array_sort(F.collect_list(F.struct("cell", F.coalesce("ts", F.array().cast("array<bigint>"))))),
                              lambda c: c["col2"]).alias("cells")))
    return stored(cells, "lexicon")


def kept_terms(terms: Column, cells: Column) -> Column:
    return F.filter(terms, lambda t: F.array_contains(F.element_at(cells, (F.pmod(t, F.lit(CELLS)) + 1).cast("int")), t))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often a
    lambda in ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def subset_hashes(kept: Column) -> Column:
    """The hash of every subset in ``SUBSETS``' order.  A rate's terms are
    taken out by their high bits first and by the last two bits then, so
    that no term is tried on all subsets."""
    def some(terms: Column, mask: int, values: Column) -> Column:
        return F.transform(values, lambda v: F.filter(terms, lambda t: t.bitwiseAND(F.lit(mask).cast("long")) == v))

    def longs(values: Iterable[int]) -> Column:
        return F.array(*[F.lit(v).cast("long") for v in values])

    def subsets(terms: Column, rate: int, at: int, n: int) -> Column:
        mask = ((1 << rate) - 1) << at
        if rate < 4 or n % 4:
            return some(terms, mask, longs(j << at for j in range(n)))
        if n < 1 << rate:
            terms = F.filter(terms, lambda t: t.bitwiseAND(F.lit(mask).cast("long")) < F.lit(n << at).cast("long"))
        high = longs(j << at + 2 for j in range(n // 4))
        return _once(terms, lambda ts: F.flatten(F.transform(
            some(ts, mask & ~(3 << at), high), lambda us: some(us, 3 << at, longs(j << at for j in range(4))))))

    def one(inside: Column) -> Column:
        return F.when(F.size(inside) == 0, F.lit(0).cast("long")).otherwise(
            F.pmod(F.xxhash64(inside), F.lit(0xFFFFFFFF)) + 1)

    return _once(kept, lambda ts: F.transform(F.concat(*[subsets(ts, *rate) for rate in RATES]), one))


def hex_print(fp: Column) -> Column:
    return F.array_join(F.transform(fp, lambda h: F.lpad(F.lower(F.hex(h)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    some = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != 0) | (y != 0)), lambda v: v))
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != 0) & (x == y)), lambda v: v))
    return F.when(some == 0, F.lit(1.0)).otherwise(same / some)


def with_fingerprint(df: DataFrame, cells: DataFrame, text: str, out: str) -> DataFrame:
    """Add ``out``, the subset hashes of column ``text``.  ``cells`` is one
    row of the band's hashes, joined to every row."""
    terms = df.withColumn("_terms", term_hashes(F.col(text))).withColumn("_one", F.lit(1))
    kept = terms.join(F.broadcast(cells.withColumn("_one", F.lit(1))), "_one")
    kept = kept.withColumn("_kept", kept_terms(F.col("_terms"), F.col("cells"))).drop("cells", "_one")
    kept = kept.withColumn("_kept", F.sort_array(F.when(F.size("_kept") > 0, F.col("_kept")).otherwise(F.col("_terms"))))
    return kept.withColumn(out, subset_hashes(F.col("_kept"))).drop("_terms", "_kept")


def _range_bucket(col: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are at most ``col``: two short
    scans, over every ``s``-th bound and over the ``s`` ones after it."""
    s = max(1, math.isqrt(len(bounds)))
    lits = [F.lit(b).cast("long") for b in bounds]
    groups = [lits[i:i + s] for i in range(0, len(lits), s)] or [[]]
    coarse = F.array(*[g[0] for g in groups if g]).cast("array<bigint>")
    fine = F.array(*[F.array(*g).cast("array<bigint>") for g in groups])
    at = F.size(F.filter(coarse, lambda b: b <= col))
    inside = F.size(F.filter(F.element_at(fine, F.greatest(at, F.lit(1))), lambda b: b <= col))
    return F.when(at == 0, F.lit(0)).otherwise((at - 1) * s + inside)


def fingerprint_pairs(df: DataFrame, min_share: float = 0.0005, max_share: float = 0.1) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half
    is replaced by the start of the next document.

    The text is shuffled once, to ranges of ids; a window inside each range
    finds the next row, and the first row of the next range stands in for
    its last one.
    """
    lowest = -(1 << 63)
    docs = df.select(F.col("doc_id"), F.coalesce("doc_id", F.lit(lowest)).alias("_ord"),
                     F.coalesce("text", F.lit("")).alias("text"))
    cells = lexicon(docs.select(term_hashes(F.col("text")).alias("terms")), min_share, max_share)
    n_parts = partitions(df.sparkSession)
    bounds = sorted({int(b) for b in docs.approxQuantile("_ord", [i / n_parts for i in range(1, n_parts)], 0.25 / n_parts)})
    docs = docs.withColumn("_tie", F.xxhash64("text"))
    prints = with_fingerprint(docs, cells, "text", "fp").withColumn("_range", _range_bucket(F.col("_ord"), bounds))
    w = Window.partitionBy("_range").orderBy("_ord", "_tie")
    rows = prints.select("*", F.lead("text").over(w).alias("_text"), F.lead("fp").over(w).alias("_fp"))

    # the first row of each range: one row per partition, read again by id
    ids = docs.select("_ord", _range_bucket(F.col("_ord"), bounds).alias("_range")).groupBy("_range").agg(
        F.min("_ord").alias("_first"))
    turn = Window.orderBy("_range")
    ids = ids.select("_first", F.coalesce(F.lag("_range").over(turn), F.max("_range").over(turn.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing))).alias("_before"))
    firsts = docs.join(F.broadcast(ids), F.col("_ord") == F.col("_first"))
    firsts = stored(firsts.groupBy("_before").agg(F.min_by("text", "_tie").alias("text")), "firsts")
    firsts = with_fingerprint(firsts, cells, "text", "fp").select("_before", F.struct("text", "fp").alias("_head"))
    rows = rows.join(firsts, F.col("_range") == F.col("_before"), "left")
    rows = (rows.withColumn("_text", F.coalesce("_text", "_head.text")).withColumn("_fp", F.coalesce("_fp", "_head.fp"))
            .withColumn("n_chars", F.length("text").cast("long")))
    half = F.expr("cast(n_chars div 2 as int)")
    rows = rows.withColumn("_edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                                               F.substring("_text", F.lit(1), half)))
    rows = with_fingerprint(rows.select("doc_id", "n_chars", "fp", "_fp", "_edited"), cells, "_edited", "_efp")
    return rows.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
                       hex_print(F.col("fp")).alias("fingerprint"), hex_print(F.col("_efp")).alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("_efp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("_fp")).alias("near_next"))


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents and their edited texts."""
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
