"""Run a registered query and its DuckDB SQL and compare rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)) or x is pd.NaT or x is pd.NA:
        return None
    if hasattr(x, "item"):
        x = x.item()
    return x


def _rows(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    rows = [tuple(_value(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((v is not None, str(type(v).__name__), v if v is not None else 0) for v in r))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    a, b = _rows(got), _rows(want)
    if len(a) != len(b):
        return f"rows {len(a)} / {len(b)}; only in one: {list(set(map(repr, a)) ^ set(map(repr, b)))[:3]}"[:900]
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, first: {str(bad[0])[:900]}"
    kinds = {c: (got[c].dtype.kind, want[c].dtype.kind) for c in got.columns}
    odd = {c: (str(got[c].dtype), str(want[c].dtype)) for c, (x, y) in kinds.items() if x != y}
    return f"types {odd}" if odd else None
