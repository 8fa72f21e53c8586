"""Check a Spark result against DuckDB reference SQL on the same Parquet tables.

Test tooling: compares row count, column names and an
order-insensitive multiset of normalised row values.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def normalised_rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {
        "spark_rows": len(s_rows),
        "oracle_rows": len(d_rows),
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
    }
    if out["columns_match"]:
        a, b = normalised_rows(s_cols, s_rows), normalised_rows(d_cols, d_rows)
        out["values_match"] = a == b
        if a != b:
            out["only_spark"] = list((a - b).elements())[:5]
            out["only_oracle"] = list((b - a).elements())[:5]
    else:
        out["values_match"] = False
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
