"""Dialogues rendered once from the perspective of every participant.

For each participant (every role of the conversation but ``system``) the
whole dialogue is written with that speaker as assistant and the others as
named users; only the assistant's words and their end marks are trained
on.  ``mask`` gives that as run lengths over the code points of
``rendered``: ``0*12 1*80 0*95``, one or two runs a turn.

A rendering is whole, whatever its length; it is stored in rows of
``part_turns`` turn numbers each, so a conversation that holds a third of
all turns is many bounded groups.  ``start`` is the code point of the whole
rendering at which a row begins: the rows of a (conversation, perspective),
in ascending start, are the rendering, and their masks, shifted by it, its
mask (``whole_renderings`` joins them where they fit into one value).
Participants are those of the whole conversation, found by an aggregation
that combines on the map side.

Defined cases: a null role speaks as ``unknown``, a null text is empty, a
turns without a number come first, in a part of their own (number null), null
conversation ids form one conversation, repeated rows are rendered as often
as they occur, turns of equal number are ordered by role and text; a
conversation without participants and an empty table give no rows; ``<|``
inside texts and names is written ``<||`` so that no text can forge a
mark (undo by replacing ``<||`` with ``<|``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import running_sum, stored, table

PART_TURNS = 64
END = "<|end|>\n"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|"), F.lit("<||"))


def rotate(df: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, part, perspective, start, n_turns, n_trained, rendered,
    mask``."""
    turns = df.select("conv_id", F.col("turn").cast("long").alias("turn"),
                      F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    speakers = (turns.filter("role <> 'system'").groupBy("conv_id", "role").agg(F.lit(1).alias("_one"))
                .select(F.col("conv_id").alias("_conv"), F.col("role").alias("perspective")))
    parts = (turns.groupBy("conv_id", F.expr(f"floor(turn / {part_turns})").cast("long").alias("part"))
             .agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")))
    seen = parts.join(speakers, parts["conv_id"].eqNullSafe(speakers["_conv"])).drop("_conv")

    def head(t: Column) -> Column:
        return (F.when(t["role"] == F.col("perspective"), F.lit("<|assistant|>\n"))
                .when(t["role"] == "system", F.lit("<|system|>\n"))
                .otherwise(F.concat(F.lit("<|user:"), _safe(t["role"]), F.lit("|>\n"))))

    def body(t: Column) -> Column:
        return F.concat(_safe(t["text"]), F.lit(END))

    def runs(t: Column) -> Column:
        a, b = F.length(head(t)), F.length(body(t))
        return F.when(t["role"] == F.col("perspective"), F.concat(F.lit("0*"), a, F.lit(" 1*"), b)).otherwise(
            F.concat(F.lit("0*"), a + b))

    rows = seen.select(
        "conv_id", "part", "perspective", F.size("turns").cast("long").alias("n_turns"),
        F.size(F.filter("turns", lambda t: t["role"] == F.col("perspective"))).cast("long").alias("n_trained"),
        F.array_join(F.transform("turns", lambda t: F.concat(head(t), body(t))), "").alias("rendered"),
        F.array_join(F.transform("turns", runs), " ").alias("mask"))
    rows = stored(rows.withColumn("_size", F.length("rendered").cast("long")), "renderings")
    # the sizes alone are summed; the texts stay where they are until the starts come back
    starts = running_sum(rows.select("conv_id", "perspective", "part", "_size"), ["conv_id", "perspective"],
                         [F.col("part").asc_nulls_first()], "_size", "start")
    r, s = rows.alias("r"), starts.alias("s")
    keys = ["conv_id", "part", "perspective"]
    on = [F.col(f"r.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    return r.join(s, on).select(*[F.col(f"r.{k}").alias(k) for k in keys], "s.start", "r.n_turns", "r.n_trained", "r.rendered", "r.mask")


def whole_renderings(rendered: DataFrame) -> DataFrame:
    """``conv_id, perspective, n_turns, n_trained, rendered, mask``: every
    rendering of ``rotate`` in one value."""
    parts = rendered.groupBy("conv_id", "perspective").agg(
        F.sum("n_turns").alias("n_turns"), F.sum("n_trained").alias("n_trained"),
        F.array_sort(F.collect_list(F.struct("start", "rendered", "mask"))).alias("_p"))
    return parts.select("conv_id", "perspective", "n_turns", "n_trained", F.array_join("_p.rendered", "").alias("rendered"),
                        F.array_join("_p.mask", " ").alias("mask"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations from all perspectives."""
    return rotate(table(spark, sf_dir, "conversations"))


ORACLE_SQL = f"""
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text,
         CAST(floor(turn / {PART_TURNS}.0) AS BIGINT) AS part
  FROM conversations),
p AS (SELECT DISTINCT conv_id, role AS perspective FROM t WHERE role <> 'system'),
r AS (
  SELECT t.conv_id, part, perspective, turn, role, text, role = perspective AS own,
         CASE WHEN role = perspective THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
              ELSE '<|user:' || replace(role, '<|', '<||') || '|>' || chr(10) END AS head,
         replace(text, '<|', '<||') || '<|end|>' || chr(10) AS body
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id)
SELECT *, CAST(coalesce(sum(length(rendered)) OVER (PARTITION BY conv_id, perspective ORDER BY part NULLS FIRST
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
FROM (
SELECT conv_id, part, perspective, count(*) AS n_turns, count(*) FILTER (WHERE own) AS n_trained,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS rendered,
       string_agg(CASE WHEN own THEN '0*' || length(head) || ' 1*' || length(body)
                       ELSE '0*' || (length(head) + length(body)) END, ' ' ORDER BY turn NULLS FIRST, role, text) AS mask
FROM r GROUP BY conv_id, part, perspective)
"""
