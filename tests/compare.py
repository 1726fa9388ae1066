"""Run a registered query and its SQL over the same tables and compare rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
}


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime):
        return v.isoformat()
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def differences(df, con, sql: str) -> str | None:
    """None when columns and multisets of rows agree, else a short description."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    types = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in cursor.description}
    odd = {c: (t, types[c]) for c, t in df.dtypes if t != types[c]}
    if odd:
        return f"types (Spark, SQL) {odd}"
    order = sorted(range(len(names)), key=lambda i: names[i])
    want = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    got = Counter(tuple(plain(v) for v in r) for r in df.select(*sorted(names)).collect())
    if got == want:
        return None
    extra, missing = got - want, want - got
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"extra {str(next(iter(extra), None))[:600]}; missing {str(next(iter(missing), None))[:600]}"
    )
