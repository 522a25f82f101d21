"""Order-insensitive result comparison (row count, column names, values)."""

from __future__ import annotations

import datetime
import hashlib
import math
import os

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest()[:16], keyed


def duckdb_views(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def run_oracle(con, sql: str):
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()
