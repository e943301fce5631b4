"""Run registered queries next to their DuckDB oracle: ``python -m tests.oracle [prefix ..]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

import __spark_entry__ as entry
from rareflow.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if v is not None and type(v).__name__ == "Decimal":
        return f"decimal:{v}"
    return repr(v)


def bag(rows, order):
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    cols = df.columns
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = [tuple(r) for r in df.collect()]
    return sorted(cols), bag(rows, order), len(rows)


def oracle_rows(con, sql):
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    rows = cur.fetchall()
    return sorted(cols), bag(rows, order), len(rows)


def compare(spark, con, name, sf_dir):
    """Returns (rows, problem): ``problem`` is None when everything matches."""
    cols, got, n = spark_rows(entry.queries()[name](spark, sf_dir))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return n, (None if n else "no rows")
    ocols, want, m = oracle_rows(con, sql)
    if cols != ocols:
        return n, f"columns {cols} != {ocols}"
    if n != m:
        return n, f"rows {n} != {m}"
    if got != want:
        a, b = list((got - want).items())[:3], list((want - got).items())[:3]
        return n, f"{sum((got - want).values())} rows differ:\n   spark  {a}\n   oracle {b}"
    return n, (None if n else "no rows")


def main(prefixes):
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in entry.queries():
        if prefixes and not any(name == p or name.startswith(p + "_") for p in prefixes):
            continue
        if os.environ.get("ONLY", "") == ("rows" if name in entry.oracle_sql() else "sql"):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            n, problem = 0, f"{type(e).__name__}: {str(e)[:700]}"
        kind = "sql " if name in entry.oracle_sql() else "rows"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {n} rows {time.time()-start:.2f}s", flush=True)
        if problem:
            print("    ", problem, flush=True)
    print("failures:", bad)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
