"""Comparison of a Spark result with the rows DuckDB gives for the oracle SQL."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    # Equal to a number but of another type, which the result's schema must not be.
    assert not isinstance(value, Decimal)
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return value.isoformat()
    return value


def bag(columns: list[str], rows) -> Counter:
    """Rows as a multiset, columns in name order."""
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in at) for row in rows)


def spark_bag(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), bag(df.columns, df.collect())


def sql_bag(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), bag(columns, result.fetchall())
