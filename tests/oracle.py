"""Runs a registered query and its SQL side by side and compares the rows."""

from __future__ import annotations

import duckdb
import pandas as pd

from lakeretrieve.registry import ORACLES, QUERIES
from lakeretrieve.registry.base import TABLE_NAMES


def connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]

    def value(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return None
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, float):
            return repr(x + 0.0)
        return repr(x)

    return sorted(tuple(str(value(x)) for x in row) for row in df.itertuples(index=False))


def compare(spark, con, sf_dir: str, name: str, df=None) -> str | None:
    """None when equal, else what differs."""
    ours = (QUERIES[name](spark, sf_dir) if df is None else df).toPandas()
    theirs = con.execute(ORACLES[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    a, b = _plain(ours), _plain(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    kinds = {c: (str(ours[c].dtype), str(theirs[c].dtype)) for c in ours.columns}
    loose = {c: k for c, k in kinds.items() if k[0] != k[1]}
    if a != b:
        n = sum(x != y for x, y in zip(a, b))
        first = next((x, y) for x, y in zip(a, b) if x != y)
        return f"{n} of {len(a)} rows differ, first {first[0]} != {first[1]} kinds {loose}"
    if not len(a):
        return "no rows at all"
    if loose:
        return f"dtypes {loose}"
    return None
