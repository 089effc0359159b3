"""Boilerplate lines found by a fixed-depth template tree, DataFrame only.

Every line is masked (tokens with a digit become ``<*>``) and falls
through a tree of fixed depth: token count, then its ``LEAD`` leading
tokens.  Templates are, per leaf,

* the masked lines themselves, and
* for leaves of ``MIN_GENERAL`` tokens or more, one generalised template:
  a position is constant if one token holds ``CONSTANT`` of the leaf's
  lines there and a variable field otherwise, and a line follows it if it
  agrees at every constant; at least ``CONSTANT`` of the positions must be
  constant.  Lines that follow no recurring one are dealt to new leaves by
  their token at the variable position where the leaf's lines agree most,
  ``SPLITS`` times, so that several templates of one leaf, or one among
  ordinary lines, come apart.

A template recurs if it stands in ``min_docs`` unrelated documents, or,
from ``LONG`` tokens on, which do not recur by chance, in ``LONG_DOCS``.
Documents are told apart by their longest line, or the next longest where
the longest is a line of the tested template, so that copies of a document
count once, however many there are, and a passage that is the longest line
of all its documents is counted as any other.  A document that has no other
line has no such mark: all of them together count once.  The depth of the
tree is fixed: token count, leading tokens and ``SPLITS`` further tokens.

Every count is an aggregation with map-side combine, first over (template,
document) and then over (template, mark), so a template in a third of all
documents is no hot group.

Defined cases: a null or empty text has one blank line and stays as it is
(null: empty text); blank lines are kept and never counted; a document
that loses every line stays with an empty text; repeated rows are treated
alike; an empty table gives no rows; other columns are ignored by
``dropped_lines`` and kept by ``dedup_documents``, whatever their names but
for ``_n_lines`` and ``_n_dropped``, which it gives anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import stored, table

LEAD = 3
MIN_GENERAL = 6
CONSTANT = 0.6
#: Levels of the tree below the leading tokens.
SPLITS = 3
MIN_DOCS = 8
#: Two documents that share a long line are mostly one and its edited copy.
LONG, LONG_DOCS = 50, 3


_MARKS = ["_one", "_two", "_own"]


def masked(line: Column) -> Column:
    """One-space-separated tokens; those with a digit are a variable."""
    flat = F.trim(F.when(line.rlike(r"[\t\r\f\x0B]|  "), F.regexp_replace(line, r"[ \t\r\f\x0B]+", " ")).otherwise(line))
    return F.when(flat.rlike("[0-9]"), F.regexp_replace(flat, "[^ ]*[0-9][^ ]*", "<*>")).otherwise(flat)


def _n_tokens(template: Column) -> Column:
    return F.length(template) - F.length(F.replace(template, F.lit(" "), F.lit(""))) + 1


def _keyed(df: DataFrame) -> DataFrame:
    """``_key`` names a document by id and text, whatever its other columns."""
    text = F.coalesce("text", F.lit(""))
    return df.select(F.xxhash64("doc_id", text).alias("_key"), F.split(text, "\n").alias("_lines"))


def _longest(templates: Column) -> Column:
    return F.array_max(F.transform(templates, lambda t: F.struct(F.length(t).alias("n"), t.alias("t"))))["t"]


def line_table(df: DataFrame) -> DataFrame:
    """One row per line that is not blank: key, hashes of the document's
    two longest templates, pos, leaf, template and token count."""
    docs = _keyed(df).select("_key", F.transform("_lines", masked).alias("_ts")).withColumn("_one", _longest(F.col("_ts")))
    docs = docs.withColumn("_two", _longest(F.filter("_ts", lambda t: (t != F.col("_one")) & (t != ""))))
    # hashed before the generator: beside it they would be made for every line
    docs = docs.select("_key", "_ts", F.xxhash64("_one").alias("_one"), F.xxhash64("_two").alias("_two"))
    lines = docs.select("_key", "_one", "_two", F.posexplode("_ts").alias("pos", "t")).filter("t <> ''")
    n = _n_tokens(F.col("t"))
    template = F.xxhash64("t")
    return lines.select("_key", "_one", "_two", (template == F.col("_one")).alias("_own"), "pos",
                        n.alias("n_tok"), template.alias("template"), F.xxhash64(n, F.substring_index("t", " ", LEAD)).alias("leaf"))


def recurring(lines: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Values of ``key`` that stand in ``min_docs`` unrelated documents,
    or in ``LONG_DOCS`` if they are long."""
    per_doc = lines.groupBy(key, "_key").agg(F.max("_own").alias("_own"), F.first("_one").alias("_one"), F.first("_two").alias("_two"),
                                             F.max("n_tok").alias("n_tok"))
    per_doc = per_doc.withColumn("_anchor", F.when(F.col("_own"), F.col("_two")).otherwise(F.col("_one")))
    per_anchor = per_doc.groupBy(key, "_anchor").agg(F.max("n_tok").alias("n_tok"))
    seen = per_anchor.groupBy(key).agg(F.count("n_tok").alias("anchors"), F.max("n_tok").alias("n_tok"))
    return seen.filter(F.col("anchors") >= F.when(F.col("n_tok") >= LONG, min(min_docs, LONG_DOCS)).otherwise(min_docs)).select(key)


def general_lines(df: DataFrame, lines: DataFrame, exact: DataFrame, min_docs: int) -> DataFrame:
    """Lines (``_key, pos``) that follow a recurring generalised template."""
    rest = lines.filter(F.col("n_tok") >= MIN_GENERAL).join(exact, "template", "left_anti")
    leaves = recurring(rest, "leaf", min_docs)
    open_lines = stored(rest.join(leaves, "leaf", "left_semi").select("_key", *_MARKS, "pos", "n_tok", "leaf"), "open_lines")
    wanted = open_lines.groupBy("_key").agg(F.collect_set("pos").alias("_wanted"))
    texts = _keyed(df).dropDuplicates(["_key"]).join(wanted, "_key")
    tokens = texts.select("_key", F.explode(F.transform("_wanted", lambda p: F.struct(
        p.alias("pos"), F.transform(F.split(masked(F.element_at("_lines", p + 1)), " "), lambda w: F.xxhash64(w)).alias("toks")))).alias("x"))
    tokens = tokens.select("_key", "x.pos", "x.toks").join(open_lines, ["_key", "pos"])
    tokens = stored(tokens, "open_tokens")
    found = []
    for turn in range(SPLITS + 1):
        votes = stored(tokens.select("leaf", F.posexplode("toks").alias("at", "tok")).groupBy("leaf", "at", "tok").agg(
            F.count(F.lit(1)).alias("n")).groupBy("leaf", "at").agg(
            F.max_by("tok", "n").alias("tok"), F.max("n").alias("n"), F.sum("n").alias("all"),
            F.sum(F.col("n").cast("double") * F.col("n")).alias("same")), "votes")
        constant = F.col("n") >= CONSTANT * F.col("all")
        form = votes.groupBy("leaf").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("at", F.when(constant, F.col("tok")).alias("tok")))),
                        lambda v: v["tok"]).alias("form"))
        form = form.filter(F.size(F.filter("form", lambda v: v.isNotNull())) >= CONSTANT * F.size("form"))
        follow = tokens.join(form, "leaf").filter(F.forall(
            F.zip_with("toks", "form", lambda a, b: b.isNull() | (a == b)), lambda v: v)).select("_key", *_MARKS, "pos", "n_tok", "leaf")
        hit = stored(follow.join(recurring(follow, "leaf", min_docs), "leaf", "left_semi").select("_key", "pos"), "followers")
        found.append(hit)
        if turn < SPLITS:
            split = votes.filter(~constant).groupBy("leaf").agg(F.max_by("at", F.struct("same", -F.col("at"))).alias("at"))
            rest = tokens.join(hit, ["_key", "pos"], "left_anti").join(split, "leaf")
            rest = rest.withColumn("leaf", F.xxhash64("leaf", "at", F.element_at("toks", F.col("at") + 1))).drop("at")
            tokens = stored(rest.join(recurring(rest, "leaf", min_docs), "leaf", "left_semi"), "open_tokens")
    return reduce(DataFrame.unionByName, found)


def dropped_lines(df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_key, _drop``: the dropped line numbers of each document."""
    lines = stored(line_table(df), "lines")
    exact = stored(recurring(lines, "template", min_docs), "templates")
    hit = lines.join(exact, "template", "left_semi").select("_key", "pos")
    hit = hit.unionByName(general_lines(df, lines, exact, min_docs))
    return hit.groupBy("_key").agg(F.collect_set("pos").alias("_drop"))


def dedup_documents(df: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``df`` without the lines of recurring templates; all columns stay,
    and ``_n_lines`` and ``_n_dropped`` are added."""
    drop = dropped_lines(df, min_docs)
    text = F.coalesce("text", F.lit(""))
    # the caller's columns travel in a struct, so that none can clash
    rows = df.select(F.xxhash64("doc_id", text).alias("_key"), text.alias("_text"), F.struct(*df.columns).alias("_row")).join(drop, "_key", "left")
    lines = F.split("_text", "\n")
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains("_drop", i)), "\n")
    new = F.when(F.col("_drop").isNull(), F.col("_text")).otherwise(kept)
    own = [c for c in df.columns if c not in ("_n_lines", "_n_dropped")]
    return rows.select(*[new.alias(c) if c == "text" else F.col("_row")[c].alias(c) for c in own], F.size(lines).cast("long").alias("_n_lines"),
                       F.coalesce(F.size("_drop"), F.lit(0)).cast("long").alias("_n_dropped"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without their boilerplate lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_documents(docs).select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), "text")


_FLAT = r"trim(regexp_replace(line, '[ \t\r\f\x0B]+', ' ', 'g'), ' ')"


def _recurring_sql(source: str, key: str, min_docs: int) -> str:
    return f"""(SELECT {key} FROM (
    SELECT {key}, CASE WHEN own THEN two ELSE one END AS anchor, max(n) AS n FROM (
      SELECT {key}, doc_id, text, one, two, bool_or(own) AS own, max(n) AS n FROM {source} GROUP BY ALL) GROUP BY ALL)
  GROUP BY {key} HAVING count(*) >= CASE WHEN max(n) >= {LONG} THEN {min(min_docs, LONG_DOCS)} ELSE {min_docs} END)"""


def oracle_sql(min_docs: int = MIN_DOCS) -> str:
    """The same rule for DuckDB: leaves and marks as texts, not hashes."""
    ctes = [rf"""docs AS (SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
raw AS (SELECT doc_id, text, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
tpl AS MATERIALIZED (SELECT doc_id, text, pos, regexp_replace({_FLAT}, '[^ ]*[0-9][^ ]*', '<*>', 'g') AS t FROM raw),
ones AS MATERIALIZED (SELECT doc_id, text, struct_extract(max(struct_pack(n := length(t), t := t)), 't') AS one FROM tpl GROUP BY ALL),
twos AS MATERIALIZED (SELECT doc_id, text, struct_extract(max(struct_pack(n := length(t), t := t)), 't') AS two FROM tpl JOIN ones USING (doc_id, text)
         WHERE t <> one AND t <> '' GROUP BY ALL),
lines AS MATERIALIZED (
  SELECT doc_id, text, pos, t, string_split(t, ' ') AS toks, len(string_split(t, ' ')) AS n, one, coalesce(two, chr(1)) AS two, t = one AS own,
         len(string_split(t, ' ')) || ' ' || array_to_string(list_slice(string_split(t, ' '), 1, {LEAD}), ' ') AS leaf
  FROM tpl JOIN ones USING (doc_id, text) LEFT JOIN twos USING (doc_id, text) WHERE t <> ''),
exact AS MATERIALIZED {_recurring_sql('lines', 't', min_docs)},
rest AS MATERIALIZED (SELECT * FROM lines ANTI JOIN exact USING (t) WHERE n >= {MIN_GENERAL}),
open0 AS MATERIALIZED (SELECT * FROM rest SEMI JOIN {_recurring_sql('rest', 'leaf', min_docs)} USING (leaf))"""]
    for k in range(SPLITS + 1):
        ctes.append(f"""votes{k} AS MATERIALIZED (
  SELECT leaf, idx, max_by(tok, c) AS tok, max(c) >= CAST({CONSTANT} AS DOUBLE) * sum(c) AS constant, sum(CAST(c AS DOUBLE) * c) AS same FROM (
    SELECT leaf, idx, tok, count(*) AS c FROM (
      SELECT leaf, unnest(toks) AS tok, generate_subscripts(toks, 1) AS idx FROM open{k}) GROUP BY ALL) GROUP BY leaf, idx),
form{k} AS (SELECT leaf, list(CASE WHEN constant THEN tok END ORDER BY idx) AS form FROM votes{k} GROUP BY leaf
  HAVING count(*) FILTER (WHERE constant) >= CAST({CONSTANT} AS DOUBLE) * count(*)),
follow{k} AS MATERIALIZED (SELECT o.* FROM open{k} o JOIN form{k} USING (leaf)
  WHERE len([x for x in list_zip(toks, form) if x[2] IS NOT NULL AND x[1] <> x[2]]) = 0),
hit{k} AS MATERIALIZED (SELECT doc_id, text, pos FROM follow{k} SEMI JOIN {_recurring_sql(f'follow{k}', 'leaf', min_docs)} USING (leaf))""")
        if k < SPLITS:
            ctes.append(f"""split{k} AS (SELECT leaf, -struct_extract(max(struct_pack(same := same, at := -idx)), 'at') AS cut FROM votes{k} WHERE NOT constant GROUP BY leaf),
left{k} AS MATERIALIZED (SELECT * REPLACE (leaf || chr(1) || cut || ' ' || toks[cut] AS leaf) FROM open{k}
  ANTI JOIN hit{k} USING (doc_id, text, pos) JOIN split{k} USING (leaf)),
open{k + 1} AS MATERIALIZED (SELECT * EXCLUDE (cut) FROM left{k} SEMI JOIN {_recurring_sql(f'left{k}', 'leaf', min_docs)} USING (leaf))""")
    hits = " UNION ".join(f"SELECT * FROM hit{k}" for k in range(SPLITS + 1))
    return "WITH " + ",\n".join(ctes) + f""",
dropped AS MATERIALIZED (SELECT doc_id, text, pos FROM lines SEMI JOIN exact USING (t) UNION {hits})
SELECT doc_id, count(*) AS n_lines, count(dropped.pos) AS n_dropped,
       coalesce(string_agg(line, chr(10) ORDER BY raw.pos) FILTER (WHERE dropped.pos IS NULL), '') AS text
FROM raw LEFT JOIN dropped USING (doc_id, text, pos) GROUP BY doc_id, raw.text
"""


ORACLE_SQL = oracle_sql()
