"""Every registered query against its DuckDB oracle at sf0.001."""

import os

import duckdb
import pytest

from oracle_check import TABLES, row_hash

SF = "/root/testdata/sf0.001"
STREAMS = {"discover_tables", "stream_commit_log", "ingest_merge", "ingest_append", "stream_progress"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _names():
    from __spark_entry__ import oracle_sql
    return sorted(oracle_sql())


def test_every_commit_log_query_has_oracle_sql():
    from __spark_entry__ import oracle_sql
    from commitlens.plans.queries import QUERIES
    from commitlens.plans.stream_queries import STREAM_QUERIES
    assert not {*QUERIES, *STREAM_QUERIES} - set(oracle_sql())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    from __spark_entry__ import oracle_sql, queries

    sql = oracle_sql()[name]
    df = queries()[name](spark, SF)
    cols = sorted(df.columns)
    srows = [tuple(r[c] for c in cols) for r in df.collect()]
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    idx = {c: i for i, c in enumerate(rel.columns)}
    drows = [tuple(r[idx[c]] for c in cols) for r in rel.fetchall()]
    assert len(srows) == len(drows)
    assert row_hash(srows) == row_hash(drows), name


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
