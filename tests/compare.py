"""Compare Spark answers with the SQL counterparts run by DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def _kind(value) -> str:
    return "null" if value is None else type(value).__name__


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=lambda r: [(v is None, str(v)) for v in r])


def differences(spark_rows, con, sql: str, most: int = 5) -> list[str]:
    mine_columns, mine = _sorted(spark_rows.columns, [tuple(r) for r in spark_rows.collect()])
    cursor = con.execute(sql)
    their_columns, theirs = _sorted([d[0] for d in cursor.description], cursor.fetchall())
    if mine_columns != their_columns:
        return [f"columns {mine_columns} != {their_columns}"]
    if len(mine) != len(theirs):
        return [f"rows {len(mine)} != {len(theirs)}"]
    found = []
    for a, b in zip(mine, theirs):
        if a != b or [_kind(v) for v in a] != [_kind(v) for v in b]:
            found.append(f"{a} != {b}")
    return found[:most]
