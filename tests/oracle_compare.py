"""Spark-vs-DuckDB comparison of registered queries (order-insensitive)."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def compare(spark, con, name: str, sf_dir: str, q, sql: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duckdb={dcols}"
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duckdb={len(drows)}"
    ss, dd = sorted(srows, key=_key), sorted(drows, key=_key)
    for a, b in zip(ss, dd):
        if a != b:
            return False, f"first differing row: spark={a} duckdb={b}"
    return True, f"{len(srows)} rows, spark {t1 - t0:.2f}s"


def main(names=None, sf_dir="/root/testdata/sf0.01"):
    import __spark_entry__ as entry
    from tripgauge.session import local_session

    spark = local_session(8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print(f"ROWS-ONLY {name}: {n} rows {time.time() - t0:.2f}s", flush=True)
            continue
        try:
            ok, msg = compare(spark, con, name, sf_dir, qs[name], sqls[name])
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"error: {str(e)[:400]}"
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {msg}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    sys.exit(1 if main(args or None, sf) else 0)
