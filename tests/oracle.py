"""Compare a registered query with its SQL: columns, types and every value, in any row order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

from starmart.plans.bindings import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return con


SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else a short description."""
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    types = [str(c[1]) for c in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    expected = {n: SPARK_TYPES.get(t, t) for n, t in zip(names, types)}
    if expected != dict(df.dtypes):
        return f"types {df.dtypes} != {expected}"
    want, got = _bag(names, found.fetchall()), _bag(df.columns, df.collect())
    if want != got:
        return (
            f"{sum(got.values())} rows, expected {sum(want.values())}; "
            f"extra {list((got - want).items())[:2]}, missing {list((want - got).items())[:2]}"
        )
    return None
