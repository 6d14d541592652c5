"""Compare a registered query with its SQL on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb


def _value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, (datetime.date, datetime.datetime, decimal.Decimal)):
        return str(v)
    if isinstance(v, float):
        return round(v, 9)
    return v


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(x is None, str(x)) for x in r])


def spark_rows(df):
    return _sorted(df.columns, [tuple(r) for r in df.collect()])


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


def spark_types(df):
    return {name: _TYPES.get(kind, kind) for name, kind in df.dtypes}


def _connect(sf_dir: str):
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


def duck_rows(sf_dir: str, sql: str):
    cur = _connect(sf_dir).execute(sql)
    return _sorted([d[0] for d in cur.description], cur.fetchall())


def duck_types(sf_dir: str, sql: str):
    return {r[0]: r[1] for r in _connect(sf_dir).execute(f"describe {sql}").fetchall()}
