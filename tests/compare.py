"""Query results of Spark and DuckDB as comparable multisets."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

FILES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def _value(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def multiset(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def spark_result(df):
    return sorted(df.columns), multiset(df.columns, df.collect())


def duckdb_result(sql: str, folder: str):
    con = duckdb.connect()
    for name in FILES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), multiset(columns, cur.fetchall())
