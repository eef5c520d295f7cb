"""Run a registered query in Spark and its SQL in DuckDB and compare:
column names, row count, and the rows as an order-insensitive multiset
(doubles compared to 1e-9 after both sides rounded to 6 decimals)."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, round(v, 6))
    if hasattr(v, "item"):
        v = v.item()
    return (3, str(v))


def compare(spark, con, query, sf_dir: str) -> tuple[bool, str]:
    sdf = query.spark(spark, sf_dir)
    s_cols = sorted(sdf.columns)
    s_rows = [tuple(_norm(r[c]) for c in s_cols) for r in sdf.collect()]
    rel = con.sql(query.oracle())
    d_cols = sorted(rel.columns)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} sql={d_cols}"
    d_df = rel.fetchall()
    idx = [rel.columns.index(c) for c in s_cols]
    d_rows = [tuple(_norm(r[i]) for i in idx) for r in d_df]
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} sql={len(d_rows)}"
    s_sorted, d_sorted = sorted(s_rows), sorted(d_rows)
    for a, b in zip(s_sorted, d_sorted):
        if a != b:
            return False, f"first differing row:\n spark={a}\n sql  ={b}"
    # the rounded double columns must be exactly those Spark emits as double
    s_doubles = {f.name for f in sdf.schema.fields if f.dataType.typeName() == "double"}
    if s_doubles != set(query.doubles):
        return False, f"double list {sorted(query.doubles)} != spark doubles {sorted(s_doubles)}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    sys.path.insert(0, ".")
    from obs_analytics.plans.registry import REGISTRY
    from obs_analytics.session import local_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or [n for n, q in REGISTRY.items() if q.sql]
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        t = time.time()
        try:
            ok, msg = compare(spark, con, REGISTRY[n], sf_dir)
        except Exception as e:  # report and go on with the next query
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} match")


if __name__ == "__main__":
    main(sys.argv)
