"""Spark against DuckDB on the same Parquet, value by value."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
            return tuple(plain(v) for v in value)
        if value is None or value is pd.NaT or (not isinstance(value, str) and pd.isna(value)):
            return None
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        if hasattr(value, "item"):
            value = value.item()
        if isinstance(value, float) and value.is_integer():
            return int(value)
        return value

    frame = frame[sorted(frame.columns)]
    rows = [tuple(plain(v) for v in row) for row in frame.astype(object).itertuples(index=False, name=None)]
    return sorted(rows, key=repr)


def kinds(frame: pd.DataFrame) -> dict[str, str]:
    return {c: str(frame[c].dtype) for c in sorted(frame.columns)}


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    ours, theirs = canonical(spark_frame), canonical(sql_frame)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{sorted(spark_frame.columns)}\n{a}\n{b}"
    return None
