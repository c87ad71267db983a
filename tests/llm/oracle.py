"""Compare a registered query with its SQL in DuckDB (used by the tests)."""

from __future__ import annotations

import math
import os

import pandas as pd

TABLES = "documents embeddings pages benchmark labels conversations".split()


def rows_of(frame) -> list[tuple]:
    cols = sorted(frame.columns)
    return sorted((tuple(_plain(v) for v in r) for r in frame[cols].itertuples(index=False, name=None)), key=repr)


def _plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v.item() if hasattr(v, "item") else v


def duckdb_rows(sql: str, sf_dir: str) -> tuple[list[str], list[tuple]]:
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    frame = con.execute(sql).df()
    return sorted(frame.columns), rows_of(frame)
