"""J5 glob consolidation as joins, without a driver-side fold.

The fold visits globs in descending order and drops every kept glob
whose prefix (text before the first ``*``) contains, or is contained
in, the prefix of the glob being added.  Its result in closed form: a
glob survives iff no glob *later* in the fold order has a related
prefix.  With the fold order (glob, id) descending, "later" means
smaller, so a glob survives iff it is the minimum of its related set.

"Related" is substring containment of prefixes.  A prefix that holds two
slashes or more can only stand in another one where the segments between
its first and last slash are a run of that one's segments; so every prefix
gives its runs of inner segments, quadratic in its depth, and meets the
prefixes whose own inner segments are such a run.  The text comparison is
made inside that equi-join.  Prefixes with fewer slashes are looked for
among the substrings of just their lengths, of which there are none as a
rule.  Both sides carry what the result needs: one pass over the distinct
prefixes, one join, one aggregation, and no job while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlens.functions.paths import glob_prefix
from commitlens.functions.sequence import bucketed_row_number
from commitlens.schemas import WC_PATH, WC_PATH_ID


def _null_fails(col: str, name: str) -> Column:
    return F.when(F.col(col).isNull(), F.raise_error(F.lit(f"{name} is NULL: a glob to consolidate has no value"))).otherwise(F.col(col))


def _containing(per_pre: DataFrame) -> DataFrame:
    """(p, p_min, q, q_min) for all prefixes p that q contains."""
    segs = F.split("pre", "/")
    inner = F.slice(segs, F.lit(2), F.greatest(F.size(segs) - 2, F.lit(0)))
    d = per_pre.withColumn("_in", inner)
    p = d.where(F.size(segs) >= 3).select(F.xxhash64("_in").alias("_run"), F.col("pre").alias("p"), F.col("kmin").alias("p_min"))
    q = (d.withColumn("_i", F.explode(F.sequence(F.lit(1), F.size("_in")))).where("size(_in) > 0")
         .withColumn("_n", F.explode(F.expr("sequence(1, size(_in) - _i + 1)")))
         .select(F.xxhash64(F.slice("_in", F.col("_i"), F.col("_n"))).alias("_run"), F.col("pre").alias("q"), F.col("kmin").alias("q_min"))
         .distinct())
    deep = q.join(p, "_run").where(F.contains("q", "p"))
    # fewer than two slashes: substrings of the lengths that occur
    short = d.where(F.size(segs) < 3)
    lengths = short.agg(F.collect_set(F.length("pre"))).scalar()
    at = (d.withColumn("_n", F.explode(lengths)).where(F.length("pre") >= F.col("_n"))
          .withColumn("_i", F.explode(F.expr("sequence(1, if(_n = 0, 1, length(pre) - _n + 1))")))
          .select(F.expr("substring(pre, _i, _n)").alias("p"), F.col("pre").alias("q"), F.col("kmin").alias("q_min")).distinct())
    flat = at.join(short.select(F.col("pre").alias("p"), F.col("kmin").alias("p_min")), "p")
    cols = ["p", "p_min", "q", "q_min"]
    return deep.select(*cols).unionByName(flat.select(*cols))


def consolidate_globs(paths: DataFrame, glob_col: str = WC_PATH,
                      id_col: str = WC_PATH_ID, strict: bool = False) -> DataFrame:
    """Consolidated (glob, id) rows and their ``rank`` in the fold's order,
    globs descending (from 1).  A NULL glob fails the query.

    Default: the substring rule (kept for parity; note ``/x/*`` then
    swallows ``/y/x/*``).  ``strict=True`` only lets a glob replace one
    it really covers: same number of segments, its prefix a
    path-prefix of the other's, at least as many stars.
    """
    g = (paths.select(F.col(glob_col).alias("glob"), F.col(id_col).alias("gid")).distinct()
         .withColumn("pre", glob_prefix("glob"))
         .withColumn("key", F.struct("glob", "gid")))
    if strict:
        g = g.withColumn("glob", _null_fails("glob", glob_col))
        return _ranked(_consolidate_strict(g, glob_col, id_col), glob_col, id_col)
    # the prefix is read from the least glob again: conditions on it then stay above the aggregation, where the globs'
    # own expression is done with; only a NULL glob has a NULL prefix
    per_pre = (g.groupBy("pre").agg(F.min("key").alias("kmin")).withColumn("pre", glob_prefix("kmin.glob"))
               .select(_null_fails("pre", glob_col).alias("pre"), "kmin"))
    pairs = _containing(per_pre)
    # each prefix with its own least glob and those of all related ones (a prefix contains itself)
    related = pairs.select(F.explode(F.array(
        F.struct(F.col("p").alias("pre"), F.col("p_min").alias("own"), F.col("q_min").alias("k")),
        F.struct(F.col("q").alias("pre"), F.col("q_min").alias("own"), F.col("p_min").alias("k")))).alias("r")).select("r.*")
    least = related.groupBy("pre").agg(F.min("own").alias("own"), F.min("k").alias("k"))
    kept = least.where(F.col("own") == F.col("k")).select(F.col("own.glob").alias(glob_col), F.col("own.gid").alias(id_col))
    return _ranked(kept, glob_col, id_col)


def _ranked(kept: DataFrame, glob_col: str, id_col: str) -> DataFrame:
    """O1: numbers in descending order, dealt by the globs' beginnings."""
    numbered = bucketed_row_number(kept.withColumn("_all", F.lit(0)), "_all", F.substring(glob_col, 1, 24),
                                   [F.col(glob_col).desc(), F.col(id_col).desc()], out="rank", descending=True)
    return numbered.select(glob_col, id_col, "rank")


def _consolidate_strict(g: DataFrame, glob_col: str, id_col: str) -> DataFrame:
    """Strict coverage: glob A covers B iff same depth, B's prefix starts
    with A's prefix at a segment boundary and A has at least as many
    ``*`` segments.  Candidates come from an equi-join on (depth,
    ancestor prefix), so again only related pairs are produced."""
    g = (g.withColumn("depth", F.size(F.split("glob", "/")))
         .withColumn("stars", F.size(F.split("glob", r"\*")) - 1))
    # every segment-boundary prefix of B's prefix, with B itself
    b = g.select("glob", "gid", "pre", "depth", "stars",
                 F.explode(F.sequence(F.lit(0), F.size(F.split("pre", "/")) - 1)).alias("k"))
    b = b.withColumn("anc", F.expr("array_join(slice(split(pre, '/'), 1, k), '/')"))
    b = b.withColumn("anc", F.when(F.col("k") == F.size(F.split("pre", "/")) - 1,
                                   F.col("pre")).otherwise(F.concat(F.col("anc"), F.lit("/"))))
    a = g.select(F.col("pre").alias("anc"), F.col("depth"), F.col("stars").alias("a_stars"),
                 F.col("key").alias("a_key"))
    covered = (b.join(a, ["anc", "depth"])
               .where((F.col("a_stars") >= F.col("stars"))
                      & (F.col("a_key") != F.struct("glob", "gid")))
               .where((F.col("pre") != F.col("anc")) | (F.col("a_stars") > F.col("stars"))
                      | (F.col("a_key") < F.struct("glob", "gid")))
               .select("glob", "gid").distinct())
    kept = g.select("glob", "gid").join(covered, ["glob", "gid"], "left_anti")
    return kept.select(F.col("glob").alias(glob_col), F.col("gid").alias(id_col))
