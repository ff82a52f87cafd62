"""Compare a registered query's Spark result with its DuckDB oracle.

Column names are compared after sorting; rows are compared as a multiset of
exact values (floats by ``repr``, dates in ISO form).
"""

from __future__ import annotations

import datetime as dt
import decimal
import os

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: tuple((x is None, str(x)) for x in t))
    return [cols[i] for i in order], out


def duck(sf_dir):
    """DuckDB connection with the driver tables registered as views."""
    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(df, con, sql) -> tuple[bool, str]:
    """(matches, message) for a Spark DataFrame against oracle SQL."""
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    if sc != dc:
        return False, f"columns spark={sc} duck={dc}"
    if len(sr) != len(dr):
        return False, f"rows spark={len(sr)} duck={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"rows={len(sr)}"
