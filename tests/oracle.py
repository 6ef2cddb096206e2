"""Comparing a Spark result with DuckDB's: same columns by name, same rows in any order."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def sorted_rows(columns, rows):
    """Columns by name, rows by content; values keep their type (1 is not 1.0)."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(repr([plain(r[i]) for i in order]) for r in rows)


def duck_rows(con, sql):
    result = con.execute(sql)
    return sorted_rows([d[0] for d in result.description], result.fetchall())


def spark_rows(df):
    return sorted_rows(df.columns, [tuple(r) for r in df.collect()])
