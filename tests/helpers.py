"""Comparison of a query with its SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    frame = frame[sorted(frame.columns)]

    def plain(v):
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return None
        if hasattr(v, "item"):
            v = v.item()
        if isinstance(v, float) and not isinstance(v, bool):
            return int(v) if v == int(v) else round(v, 9)
        return v if isinstance(v, (bool, int, str)) else str(v)

    rows = [tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False)]
    return list(frame.columns), sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))
