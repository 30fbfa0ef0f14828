"""Side-by-side comparison of a registered query and its SQL oracle."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def oracle_rows(sql: str, folder: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return names, types, result.fetchall()


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return repr(value + 0.0)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def mismatch(df, sql: str, folder: str) -> str | None:
    """None when columns, types and rows agree, else a short description."""
    names, types, want = oracle_rows(sql, folder)
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {c: KINDS.get(k, k) for c, k in df.dtypes}
    wrong = {n: (kinds[n], t) for n, t in zip(names, types) if kinds[n] != t}
    got = [tuple(r) for r in df.collect()]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _sorted(df.columns, got), _sorted(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. spark={bad[0][0]} sql={bad[0][1]}"
    if wrong:
        return f"types {wrong}"
    return None
