"""Spark vs DuckDB oracle comparison (row count, column names, order-insensitive values)."""

from __future__ import annotations

import collections
import datetime as dt
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return repr(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark, name, fn, sql, sf_dir, con):
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    problems = []
    if sorted(s_cols) != sorted(o_cols):
        problems.append(f"columns spark={sorted(s_cols)} oracle={sorted(o_cols)}")
        return problems
    if len(s_rows) != len(o_rows):
        problems.append(f"rows spark={len(s_rows)} oracle={len(o_rows)}")
    a, b = rows_of(s_cols, s_rows), rows_of(o_cols, o_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_o = list((b - a).elements())[:3]
        problems.append(f"values differ: {sum((a - b).values())} spark-only e.g. {only_s}; oracle-only e.g. {only_o}")
    return problems


def main(sf_dir, names):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as E
    from mercadia.session import build_session
    spark = build_session()
    con = duck(sf_dir)
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        if name not in os_:
            print(f"NOORACLE {name}")
            continue
        t = time.time()
        try:
            probs = compare(spark, name, fn, os_[name], sf_dir, con)
        except Exception as e:  # noqa: BLE001
            probs = [f"error: {str(e)[:800]}"]
        bad += bool(probs)
        print(("MATCH " if not probs else "DIFF  ") + f"{name} ({time.time() - t:.1f}s) " + " | ".join(probs))
    print(f"{bad} mismatching")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
