"""Side-by-side check of a Spark query against its DuckDB oracle.

Mirrors the driver's gate: same column names, same row count, same
order-insensitive multiset of values (floats compared at 1e-6).
"""
from __future__ import annotations

import math
import datetime as dt

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
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return round(float(v), 6) + 0.0
    except Exception:
        pass
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    data = cur.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, [tuple(_norm(r[i]) for i in idx) for r in data]


def _key(t):
    return tuple((x is None, str(type(x)), str(x)) for x in t)


def compare(df, con, sql):
    sc, sr = rows_of_spark(df)
    dc, dr = rows_of_duck(con, sql)
    if sc != dc:
        return False, f"columns differ: spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duck={len(dr)}"
    a, b = sorted(sr, key=_key), sorted(dr, key=_key)
    for x, y in zip(a, b):
        if x != y:
            diffs = [(c, p, q) for c, p, q in zip(sc, x, y) if p != q]
            return False, f"value mismatch e.g. {diffs[:4]}"
    return True, f"{len(sr)} rows"
