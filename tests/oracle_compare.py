"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest (``compare``) and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
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

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols: list[str], rows) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, name: str, fn, sql: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    info = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
            "spark_sec": round(t1 - t0, 2), "duck_sec": round(t2 - t1, 2),
            "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not info["cols_match"]:
        info["spark_cols"], info["duck_cols"] = sorted(s_cols), sorted(d_cols)
        info["match"] = False
        return info
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    info["match"] = a == b
    if not info["match"]:
        sa, sb = set(a), set(b)
        info["only_spark"] = list(sa - sb)[:3]
        info["only_duck"] = list(sb - sa)[:3]
    return info


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = set(argv[2:])
    import __spark_entry__ as entry
    from martlake.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    oracle = entry.oracle_sql()
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        if name not in oracle:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print({"name": name, "rows_only": n, "sec": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            info = compare(spark, con, name, fn, oracle[name], sf_dir)
        except Exception as e:  # report and go on
            info = {"name": name, "match": False, "error": str(e)[:400]}
        bad += not info["match"]
        print(info, flush=True)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
