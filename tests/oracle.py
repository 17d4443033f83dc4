"""Compare a Spark result with the same query run by DuckDB (test helper, small data only)."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

from forecourt.sources.tables import TESTDATA_TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TESTDATA_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{table_path(sf_dir, name)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        # exact: money is summed as decimals, so both engines produce the same double
        return None if math.isnan(v) else v
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return int(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows), sorted(names)


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_names = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    s_counter, s_cols = _rows(s_names, s_rows)
    d_counter, d_cols = _rows(d_names, d_rows)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} duckdb={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}"
    if s_counter != d_counter:
        only_s = list((s_counter - d_counter).elements())[:3]
        only_d = list((d_counter - s_counter).elements())[:3]
        return False, f"values differ; spark-only={only_s} duckdb-only={only_d}"
    return True, f"{len(s_rows)} rows"
