"""Compares a query's rows with its SQL in DuckDB over the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def assert_same(df, connection, sql: str) -> None:
    columns = sorted(df.columns)
    ours = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = connection.execute(sql)
    names = [x[0] for x in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
    assert ours == theirs
