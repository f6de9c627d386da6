"""Runs registered queries against their SQL and reports differences."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def cell(value):
    if value is None:
        return "~"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, int):
        return str(value)
    return str(value)


def table(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
}


def difference(df, con, sql: str) -> str | None:
    """None when both sides have the same columns, types and rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    for field in df.schema:
        want = KINDS.get(field.dataType.simpleString(), "?")
        if kinds[field.name] != want:
            return f"type of {field.name}: {field.dataType.simpleString()} against {kinds[field.name]}"
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    theirs = table(names, rows)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} against {b} (columns {sorted(names)})"
    return None
