"""A query's rows against those of its SQL."""

import glob
import os

import duckdb
import pandas as pd


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{d}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def text(v) -> str:
    if v is None or v is pd.NA or v is pd.NaT or v != v:
        return "null"
    if isinstance(v, bool) or type(v).__name__.startswith("bool"):
        return str(bool(v))
    try:
        return f"{round(float(v), 5) + 0.0:.5f}"
    except (TypeError, ValueError):
        return str(v)


def rows(df: pd.DataFrame) -> list[tuple[str, ...]]:
    names = sorted(df.columns)
    return sorted(tuple(text(v) for v in r) for r in df[names].astype(object).itertuples(index=False))


def same(query, sql: str, spark, d: str) -> None:
    mine, theirs = query(spark, d).toPandas(), connect(d).sql(sql).df()
    assert sorted(mine.columns) == sorted(theirs.columns)
    assert rows(mine) == rows(theirs)
