"""Spark result vs DuckDB oracle: same columns, row count and (order-free) values.

Usable from pytest and as a script:  python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    con = duck(sf_dir)
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ spark={s_cols} duck={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"{name}: rows spark={len(s_rows)} duck={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"{name}: first diff\n spark={x}\n duck ={y}"
    return True, f"{name}: ok {len(s_rows)} rows in {t1 - t0:.1f}s"


def main(argv):
    from __spark_entry__ import oracle_sql, queries
    from txflow.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or sorted(queries())
    spark = build_session()
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for n in names:
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print(f"{n}: no oracle, {df.count()} rows")
            continue
        try:
            ok, msg = compare(spark, sf_dir, n, qs[n], sqls[n])
        except Exception as e:  # report and go on
            ok, msg = False, f"{n}: ERROR {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(("PASS " if ok else "FAIL ") + msg, flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
