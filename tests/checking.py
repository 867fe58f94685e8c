"""Runs a registered query on Spark and its SQL on DuckDB and compares rows."""

from __future__ import annotations

import datetime
import decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


KIND = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
        "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP"}


def compare(df, con, sql: str) -> str | None:
    """None when columns, types and rows agree, else what differs."""
    relation = con.execute(sql)
    names = [c[0] for c in relation.description]
    types = {n: t for n, t, *_ in con.execute(f"describe {sql}").fetchall()}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    wrong = {n: (t, types[n]) for n, t in df.dtypes if KIND.get(t, t) != types[n]}
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    theirs = con.execute(f"select {', '.join(order)} from ({sql})").fetchall()
    ours = df.select(*order).collect()
    key = lambda row: tuple((v is not None, str(v)) for v in row)
    a = sorted((tuple(plain(v) for v in r) for r in ours), key=key)
    b = sorted((tuple(plain(v) for v in r) for r in theirs), key=key)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}; only ours {list(set(a) - set(b))[:2]}; only theirs {list(set(b) - set(a))[:2]}"
    for x, y in zip(a, b):
        if x != y:
            return f"row {x} vs {y}"
    return None
