"""Compare a Spark result with the same query run by DuckDB, values and all."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def spark_rows(df: DataFrame) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(_plain(v) for v in r) for r in rows)


def duck_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], Counter]:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in cur.fetchall())
    return [names[i] for i in order], rows
