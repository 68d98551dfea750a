"""Compare a query with its SQL on the same tables, value by value."""

from __future__ import annotations

import glob
import math
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    return value.item() if hasattr(value, "item") else value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda row: tuple((v is None, str(type(v)), str(v)) for v in row))


# Type names that mean the same in both engines.
KINDS = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and the result of its SQL; empty if nothing."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    kinds = {d[0]: str(d[1]) for d in found.description}
    expected = rows_of(names, found.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for name, kind in df.dtypes:
        if KINDS.get(kind) != kinds[name]:
            problems.append(f"type of {name}: {kind} != {kinds[name]}")
    actual = rows_of(df.columns, df.collect())
    if len(actual) != len(expected):
        problems.append(f"rows {len(actual)} != {len(expected)}")
    if actual != expected:
        first = next(((a, e) for a, e in zip(actual, expected) if a != e), None)
        problems.append(f"first difference {first}")
    return problems
