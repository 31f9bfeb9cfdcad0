"""Rows of a Spark query and of its SQL, in a form that can be compared."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, list | tuple):
        return tuple(plain(x) for x in v)
    if isinstance(v, bool):
        return v
    return float(v) if isinstance(v, int | float) else v


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in values), key=repr)


def of_spark(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def of_sql(sql, data=DATA, **frames):
    con = duckdb.connect()
    for t in TABLES:
        if (Path(data) / f"{t}.parquet").exists() and t not in frames:
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    for name, frame in frames.items():
        con.register(name, frame)
    found = con.sql(sql)
    return rows(found.columns, found.fetchall())
