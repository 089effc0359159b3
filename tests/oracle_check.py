"""Run every registered query on Spark and its oracle SQL on DuckDB and
compare row count, column names/types and an order-free value hash.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402,F401

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 6))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    return str(v)


def row_hash(rows):
    hs = sorted(hashlib.sha1("|".join(norm(x) for x in r).encode()).hexdigest() for r in rows)
    return hashlib.sha1("".join(hs).encode()).hexdigest()


def main():
    from __spark_entry__ import oracle_sql, queries
    from commitlens.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    qs, sq = queries(), oracle_sql()
    ok = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = sorted(df.columns)
            srows = [tuple(r[c] for c in cols) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        ts = time.time() - t0
        if name not in sq:
            print(f"{name:28s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(sq[name])
            dcols = rel.columns
            drows_all = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} DUCK-ERROR {str(e)[:300]}")
            continue
        idx = {c: i for i, c in enumerate(dcols)}
        if sorted(dcols) != cols:
            print(f"{name:28s} COLUMNS spark={cols} duck={sorted(dcols)}")
            continue
        drows = [tuple(r[idx[c]] for c in cols) for r in drows_all]
        same = len(srows) == len(drows) and row_hash(srows) == row_hash(drows)
        ok += same
        print(f"{name:28s} {'OK  ' if same else 'DIFF'} spark={len(srows)} duck={len(drows)} {ts:.1f}s")
        if not same:
            a = set(map(lambda r: tuple(map(norm, r)), srows))
            b = set(map(lambda r: tuple(map(norm, r)), drows))
            print("   cols:", cols)
            print("   spark-only:", list(a - b)[:3])
            print("   duck-only: ", list(b - a)[:3])
    print(f"matched {ok}")


if __name__ == "__main__":
    main()
