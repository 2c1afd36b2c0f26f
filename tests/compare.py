"""Spark query vs DuckDB oracle: row count, column names, order-insensitive values.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

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


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: repr(r))


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


SPARK_TO_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
                 "date": "DATE", "boolean": "BOOLEAN"}


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict[str, str]:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    result = {}
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if name not in sqls:
            result[name] = f"rows-only ({len(s_rows)})"
            continue
        rel = con.sql(sqls[name])
        d_cols = rel.columns
        d_rows = rel.fetchall()
        sc, sr = canon(s_cols, s_rows)
        dc, dr = canon(d_cols, d_rows)
        s_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
        d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
        if sc != dc:
            status = f"COLUMNS {sc} != {dc}"
        elif s_types != d_types:
            status = f"TYPES {s_types} != {d_types}"
        elif len(sr) != len(dr):
            status = f"ROWS {len(sr)} != {len(dr)}"
        elif sr != dr:
            diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
            status = f"VALUES differ, e.g. {diff}"
        else:
            status = "ok"
        result[name] = status
        if verbose:
            print(f"{name:32s} {status[:300]}  rows={len(s_rows)} spark={t1 - t0:.2f}s", flush=True)
    return result


if __name__ == "__main__":
    from ledgerlake.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", extra={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if v != "ok" and not v.startswith("rows-only")}
    print(f"{len(res) - len(bad)}/{len(res)} ok")
    sys.exit(1 if bad else 0)
