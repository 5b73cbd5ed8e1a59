"""Order-insensitive comparison of a Spark result with a DuckDB query (tests and local checks)."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for n in DRIVER_TABLES:
        try:
            con.execute(f"create view {n} as select * from read_parquet('{sf_dir}/{n}.parquet')")
        except Exception:  # pragma: no cover - a table may be absent in a scratch dir
            pass
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else None
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def table_digest(columns: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), h


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    s_n, s_h = table_digest(s_cols, s_rows)
    d_n, d_h = table_digest(d_cols, d_rows)
    return {
        "rows_spark": s_n,
        "rows_oracle": d_n,
        "columns_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": s_h == d_h and sorted(s_cols) == sorted(d_cols),
        "spark_columns": s_cols,
        "oracle_columns": d_cols,
    }
