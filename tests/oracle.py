"""Run a registered query and its SQL side by side and compare every value."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


_KINDS = {
    "tinyint": "int", "smallint": "int", "integer": "int", "int": "int", "bigint": "int", "hugeint": "hugeint",
    "double": "double", "float": "double", "varchar": "string", "string": "string", "boolean": "bool",
    "timestamp": "timestamp", "timestamp_ntz": "timestamp", "date": "date",
}


def _key(value):
    return (value is None, str(type(value)), value if value is not None else 0)


def _clean(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def compare(df, con, sql: str) -> list[str]:
    """Differences in names, kinds of types, row counts and exact values; empty when equal."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {r[0]: r[1].lower() for r in described}
    ours = dict(df.dtypes)
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    names = sorted(ours)
    out = []
    for n in names:
        a, b = _KINDS.get(ours[n], ours[n]), _KINDS.get(theirs[n], theirs[n])
        if a != b:
            out.append(f"type of {n}: {ours[n]} against {theirs[n]}")
    left = [tuple(_clean(r[n]) for n in names) for r in df.collect()]
    columns = ", ".join(f'"{n}"' for n in names)
    right = [tuple(_clean(v) for v in r) for r in con.execute(f"SELECT {columns} FROM ({sql})").fetchall()]
    if len(left) != len(right):
        out.append(f"rows {len(left)} against {len(right)}")
    left.sort(key=lambda r: tuple(map(_key, r)))
    right.sort(key=lambda r: tuple(map(_key, r)))
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {dict(zip(names, zip(*bad[0])))}")
    return out
