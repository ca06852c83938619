"""Side-by-side check of a Spark result against a DuckDB query.

Mirrors the round's correctness gate: same column names (sorted), same row
count, and the same multiset of rows after normalising floats to 6 places.
"""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
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
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in records]


def compare(spark_df, sql: str, sf_dir: str, con=None):
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    assert sorted(scols) == sorted(dcols), f"columns differ: {sorted(scols)} vs {sorted(dcols)}"
    a = Counter(rows_of(scols, srows))
    b = Counter(rows_of(dcols, drows))
    assert len(srows) == len(drows), f"row counts differ: spark {len(srows)} duckdb {len(drows)}"
    if a != b:
        only_a = list((a - b).items())[:5]
        only_b = list((b - a).items())[:5]
        raise AssertionError(f"values differ; spark-only {only_a}; duckdb-only {only_b}")
    return len(srows)
