"""Catalogue clean-up and status."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sunloom.operators.quality import table_status
from sunloom.tables import TABLES, read_table, table_exists, table_path


def stored_status(spark: SparkSession, root: str) -> DataFrame:
    """Declared tables against those below ``root``: presence, rows, time range."""
    frames = {}
    for name, spec in TABLES.items():
        there = table_exists(spark, table_path(root, name))
        frames[name] = read_table(spark, root, spec).select("datetime") if there else None
    if not any(f is not None for f in frames.values()):
        raise ValueError(f"no declared table below {root}")
    return table_status(frames, {name: "datetime" for name in frames})
