"""Run a named query and its SQL counterpart; compare as unordered rows."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(f)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{f}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime) and v.tzinfo is not None:
        return v.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), _rows(columns, cur.fetchall())
