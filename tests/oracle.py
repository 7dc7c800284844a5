"""Compare a query with its SQL in DuckDB, as sets of rows with repetitions."""

import glob
import os
from collections import Counter

import duckdb
import pandas as pd


def _cell(v):
    if pd.api.types.is_scalar(v) and pd.isna(v):
        return None
    if hasattr(v, "year"):
        return str(pd.Timestamp(v))
    if isinstance(v, (bool, str)):
        return v
    return round(float(v), 6) if hasattr(v, "__float__") else v


def rows(frame: pd.DataFrame) -> Counter:
    frame = frame[sorted(frame.columns)]
    return Counter(tuple(_cell(v) for v in r) for r in frame.astype(object).itertuples(index=False))


def connect(directory: str):
    con = duckdb.connect()
    for p in glob.glob(f"{directory}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con
