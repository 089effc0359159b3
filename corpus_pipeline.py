"""Corpus preparation: toxicity, line dedup, near duplicates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs,
sf_dir) and returns a DataFrame that is written as Parquet and read again
as the next one's ``docs``.  All but the last return the columns of
``documents``.

Defined cases are those of the operators: a null text counts as empty,
empty documents pass every filter, repeated rows are judged alike (the
near-duplicate stage keeps one row of a group, also among rows that repeat
an id), an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlens.llm.common import stored, table
from commitlens.llm.jaccard_join import JaccardJoin
from commitlens.llm.line_dedup import dedup_documents
from commitlens.llm.packing import pack
from commitlens.llm.toxicity import train, with_scores

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half."""
    model = train(docs, table(spark, sf_dir, "labels"))
    return with_scores(docs, model, keep=COLUMNS).filter("score < 0.5").select(*COLUMNS)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates."""
    return dedup_documents(docs.select(*COLUMNS)).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link: the one of
    the smallest id, and among rows of that id one of them."""
    found = JaccardJoin(docs)
    return found.representatives(docs.select(*COLUMNS))


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document that is left."""
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate),
    ("ngram_jaccard_join", drop_near_copies),
    ("packing", pack_lengths),
]

#: A trained model and connected components are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
