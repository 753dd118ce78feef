"""Runs a query and its SQL and compares their rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (int, float, decimal.Decimal)):
        return float(x) if isinstance(x, float) else int(x) if int(x) == x else float(x)
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return str(x) if not isinstance(x, (list, tuple)) else tuple(map(plain, x))


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differ(spark, con, query, sql, sf_dir):
    """None if the rows agree, else what does not."""
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    theirs = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {df.columns} {names}"
    if mine != theirs:
        odd = [(a, b) for a, b in zip(mine, theirs) if a != b][:2]
        return f"{len(mine)} and {len(theirs)} rows; {odd}"
    return None
