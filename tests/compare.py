"""Run a registered query and its SQL on the same Parquet tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and v != v:
        return None
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return v.date()
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _table(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def difference(df, sql: str, con) -> str | None:
    """None when equal, else a short description of the first difference."""
    mine = _table(df.columns, df.collect())
    found = con.execute(sql)
    theirs = _table([d[0] for d in found.description], found.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"rows {len(mine[1])} != {len(theirs[1])}"
    kinds = {(type(x), type(y)) for a, b in zip(mine[1], theirs[1]) for x, y in zip(a, b)}
    odd = [k for k in kinds if k[0] is not k[1] and type(None) not in k]
    if odd:
        return f"types {odd}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1]) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine[1])} rows differ, first {bad[0]}"
    return None
