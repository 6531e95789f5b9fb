"""Runs registered queries beside their SQL in DuckDB and compares values.

Usage: python check.py [name-part ...]   (CHECK_SF_DIR chooses the tables)
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from millrace.plans import all_queries
from millrace.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def database(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    return con


def canon(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v) + 0.0)
    return str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, q, root: str) -> tuple[bool, str]:
    start = time.time()
    df = q.run(spark, root)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    if q.sql is None:
        return True, f"{spent:6.2f}s {len(got):7d} rows (no SQL)"
    start = time.time()
    cur = con.execute(q.sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    sql_spent = time.time() - start
    if sorted(names) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    note = f"{spent:6.2f}s {len(a):7d} rows, sql {sql_spent:5.2f}s {len(b):7d} rows"
    if a != b:
        left, right = set(a) - set(b), set(b) - set(a)
        cols = sorted(names)
        return False, note + f"\n   {cols}\n   spark only {len(left)}: {sorted(left)[:3]}\n   sql only   {len(right)}: {sorted(right)[:3]}"
    return True, note


def main() -> int:
    root = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    parts = sys.argv[1:]
    spark = local_session("8", "check")
    spark.sparkContext.setLogLevel("ERROR")
    con = database(root)
    bad = []
    for name, q in all_queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            ok, note = compare(spark, con, q, root)
        except Exception as e:  # report and go on with the next query
            ok, note = False, f"{type(e).__name__}: {str(e)[:400]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {note}", flush=True)
        if not ok:
            bad.append(name)
    print(f"{len(bad)} failed: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
