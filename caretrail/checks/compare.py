"""Run registered queries on Spark and their SQL on DuckDB, and compare row by row."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(value):
    if value is None or isinstance(value, bool):
        return None if value is None else int(value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return int(value) if value.is_integer() else round(value, 6)
    if isinstance(value, dt.datetime):
        value = value.replace(tzinfo=None)
        return value.date().isoformat() if value.time() == dt.time() else value.isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(run, sql: str | None, spark, con, folder: str) -> dict:
    start = time.monotonic()
    df = run(spark, folder)
    columns = df.columns
    rows = [tuple(r) for r in df.collect()]
    out = {"rows": len(rows), "seconds": round(time.monotonic() - start, 2), "ok": True, "why": ""}
    if sql is None:
        out["why"] = "rows only"
        return out
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(columns):
        return {**out, "ok": False, "why": f"columns {sorted(set(names) ^ set(columns))}"}
    a, b = sorted_rows(columns, rows), sorted_rows(names, expected)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        cols = sorted(columns)
        detail = ""
        if only_a and only_b and len(a) == len(b):
            detail = str([(c, x, y) for c, x, y in zip(cols, only_a[0], only_b[0]) if x != y][:8])
        return {**out, "ok": False, "why": f"{len(a)} vs {len(b)} rows; spark {str(only_a)[:600]} sql {str(only_b)[:600]} {detail}"}
    return out
