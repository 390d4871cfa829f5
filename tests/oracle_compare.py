"""Run registered queries on Spark and their SQL twins on DuckDB, and
compare row count, column names and an order-insensitive value hash.

    python tests/oracle_compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(float(v))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex().upper()
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "is_integer") or isinstance(v, int):
        return str(int(v)) if float(v).is_integer() else repr(float(v))
    return str(v)


def digest(columns, rows) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]
    return [columns[i] for i in order], len(rows), h


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, dict]:
    from __spark_entry__ import oracle_sql, queries
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t = time.time()
        rec = {}
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            s_cols, s_n, s_h = digest(df.columns, rows)
            rec.update(spark_rows=s_n, spark_sec=round(time.time() - t, 2))
            if name in sqls:
                res = con.execute(sqls[name])
                d_cols = [c[0] for c in res.description]
                o_cols, o_n, o_h = digest(d_cols, res.fetchall())
                rec.update(oracle_rows=o_n, cols_match=s_cols == o_cols, hash_match=s_h == o_h,
                           ok=(s_cols == o_cols and s_n == o_n and s_h == o_h))
                if s_cols != o_cols:
                    rec["cols"] = (s_cols, o_cols)
            else:
                rec["ok"] = None
        except Exception as e:  # report and continue
            rec.update(ok=False, error=f"{type(e).__name__}: {str(e)[:300]}")
        out[name] = rec
        if verbose:
            print(name, rec, flush=True)
    return out


if __name__ == "__main__":
    from occurrence_lake.config import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad if bad else "none")
