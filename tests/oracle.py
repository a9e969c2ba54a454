"""Runs a query's SQL counterpart in DuckDB and compares names, types and values."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
SPARK_NAME = {
    "INTEGER": "int",
    "BIGINT": "bigint",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def differences(con, sql: str, df) -> list[str]:
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = {d[0]: SPARK_NAME.get(str(d[1]), str(d[1])) for d in rel.description}
    expected = rel.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    for name, kind in df.dtypes:
        if types[name] != kind:
            found.append(f"{name}: {kind} instead of {types[name]}")
    order = sorted(names)
    at = [names.index(n) for n in order]
    left = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in order]).collect()), key=_key)
    right = sorted((tuple(r[i] for i in at) for r in expected), key=_key)
    if len(left) != len(right):
        found.append(f"{len(left)} rows instead of {len(right)}")
    for a, b in zip(left, right):
        if a != b and not _same(a, b):
            found.append(f"first difference: {dict(zip(order, a))} instead of {dict(zip(order, b))}")
            break
    return found


def _same(a, b) -> bool:
    return all(
        x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
        for x, y in zip(a, b)
    )
