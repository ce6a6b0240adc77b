"""Compares a table with the SQL that should give the same rows."""

import glob
import os

import duckdb
import pandas as pd


def views(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(rows: pd.DataFrame) -> list[tuple]:
    def cell(x):
        if x is None or x != x:
            return "null"
        return f"{x:.6g}" if isinstance(x, float) else str(x)

    return sorted(tuple(cell(x) for x in r) for r in rows[sorted(rows.columns)].itertuples(index=False))


def same(got: pd.DataFrame, want: pd.DataFrame) -> None:
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
