"""Results of Spark and DuckDB side by side."""

import duckdb
import pandas as pd

DATA = "/root/testdata/sf0.001"


def connect(folder: str = DATA) -> duckdb.DuckDBPyConnection:
    import glob
    import os

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return con


def _text(v: object) -> str:
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return "NULL"
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows_of(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(_text, r)) for r in frame.itertuples(index=False))
