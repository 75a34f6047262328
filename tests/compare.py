"""Compare the registered queries with their SQL in DuckDB on the same tables."""

from __future__ import annotations

import datetime as dt
import math
import pathlib

import duckdb


TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str, limit: int = 5) -> list[str]:
    """Empty when columns, row number and values are the same."""
    got = _rows(df.columns, df.collect())
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = _rows(names, result.fetchall())
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    kinds = {c[0]: str(c[1]).upper() for c in result.description}
    out = [f"{name}: {dtype} / {kinds[name]}" for name, dtype in df.dtypes
           if TYPES.get(dtype) != kinds[name]]
    out += [] if len(got) == len(want) else [f"rows {len(got)} / {len(want)}"]
    pairs = [(a, b) for a, b in zip(got, want) if a != b or [type(x) for x in a] != [type(x) for x in b]]
    return out + [f"{sorted(names)}\n  spark {a}\n  sql   {b}" for a, b in pairs[:limit]]
