"""Run registry queries in Spark and their oracle SQL in DuckDB on the same tables and compare
column names, row counts and order-insensitive values.  Usage:

    python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, bool):
        return (1, int(v))
    if isinstance(v, (int,)):
        return (1, v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return (1, f) if math.isnan(f) else (1, round(f, 6))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return (2, bytes(v).hex())
    if isinstance(v, (dt.datetime, dt.date)):
        return (2, v.isoformat())
    return (2, str(v))


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}", t1 - t0, t2 - t1
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = {c: i for i, c in enumerate(d_cols)}
    s_set = sorted(tuple(norm(r[i]) for i in order) for r in s_rows)
    d_set = sorted(tuple(norm(r[d_idx[s_cols[i]]]) for i in order) for r in d_rows)
    if len(s_set) != len(d_set):
        return False, f"rows differ: spark={len(s_set)} duck={len(d_set)}", t1 - t0, t2 - t1
    if s_set != d_set:
        bad = [(a, b) for a, b in zip(s_set, d_set) if a != b][:2]
        return False, f"values differ ({len(s_set)} rows), e.g. {bad}"[:600], t1 - t0, t2 - t1
    return True, f"{len(s_set)} rows", t1 - t0, t2 - t1


def main(argv):
    sf_dir = argv[0] if argv and not argv[0].isidentifier() else "/root/testdata/sf0.01"
    keys = [a for a in argv if a.isidentifier()]
    import __spark_entry__ as E
    from pagesmith.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    failed = []
    for k in keys or list(qs):
        if k not in sqls:
            print(f"{k:28s} (no oracle)")
            continue
        try:
            ok, msg, ts, td = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as e:  # report and go on
            ok, msg, ts, td = False, f"{type(e).__name__}: {str(e)[:400]}", 0, 0
        print(f"{k:28s} {'OK ' if ok else 'BAD'} spark {ts:6.1f}s duck {td:5.1f}s  {msg}", flush=True)
        if not ok:
            failed.append(k)
    print("FAILED:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
