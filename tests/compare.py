"""Side-by-side check of a Spark result and a DuckDB result."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else (repr(v + 0.0))
    if isinstance(v, int):
        return v
    if hasattr(v, "as_tuple"):
        return float(v)
    return v if isinstance(v, (str, list, tuple)) else str(v)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(map(str, (_cell(r[i]) for i in order))) for r in rows)


def differences(df, con, sql) -> str | None:
    """None if both results agree, else a short description."""
    got = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    a, b = bag(df.columns, got), bag(names, want)
    if a != b:
        return (f"{sum((a - b).values())} of {len(got)} rows differ: "
                f"{list((a - b).items())[:2]} vs {list((b - a).items())[:2]}")
    kinds = dict(zip(names, [str(d[1]) for d in result.description]))
    odd = {f.name: (f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields
           if (f.dataType.simpleString(), kinds[f.name].upper()) not in _SAME}
    return f"types {odd}" if odd else None


_SAME = {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"),
         ("boolean", "BOOLEAN"), ("timestamp_ntz", "TIMESTAMP"), ("date", "DATE")}
