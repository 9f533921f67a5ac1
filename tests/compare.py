"""Run a registered query next to its SQL twin and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(cell(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(cell(r[i])).__name__, cell(r[i])) for i in order) for r in rows)


def compare(frame, con, sql: str):
    """None when equal, else a short text on what differs."""
    left_names = frame.columns
    cursor = con.execute(sql)
    right_names = [d[0] for d in cursor.description]
    right = rows_of(right_names, cursor.fetchall())
    left = rows_of(left_names, [tuple(r) for r in frame.collect()])
    if sorted(left_names) != sorted(right_names):
        only = sorted(set(left_names) ^ set(right_names))
        return f"columns differ: {only}"
    if not left and not right:
        return "both results are empty"
    if left == right:
        return None
    missing, extra = right - left, left - right
    return (
        f"rows: spark {sum(left.values())}, sql {sum(right.values())}; "
        f"columns {sorted(left_names)}; "
        f"only in sql {sum(missing.values())} e.g. {[[v for _, v in r] for r in list(missing)[:1]]}; "
        f"only in spark {sum(extra.values())} e.g. {[[v for _, v in r] for r in list(extra)[:1]]}"
    )
