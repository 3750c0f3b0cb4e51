"""Compare every named query with its SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surgelens.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name, run, sql, sf_dir):
    """None if equal, else what differs; plus the Spark time and row count."""
    start = time.time()
    df = run(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, took, len(got)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    want = want.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}", took, len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a, only_b = [r for r in a if r not in b][:2], [r for r in b if r not in a][:2]
        return f"{len(a)} vs {len(b)} rows; {only_a} vs {only_b}", took, len(got)
    return None, took, len(got)


def main():
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name, run in entry.queries().items():
        if wanted and name not in wanted:
            continue
        try:
            wrong, took, n = compare(spark, con, name, run, entry.oracle_sql().get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            wrong, took, n = f"{type(e).__name__}: {str(e)[:600]}", 0.0, -1
        failed += wrong is not None
        kind = "sql" if name in entry.oracle_sql() else "rows"
        print(f"{'FAIL' if wrong else 'ok':4} {name:26} {n:7} rows {took:6.2f}s {kind} {wrong or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
