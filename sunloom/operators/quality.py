"""Counts: missing values, classes, outcomes, table ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunloom.functions.numbers import is_missing


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing, total)`` in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("_total"), *[F.count_if(is_missing(df, c)).alias(f"_{i}") for i, c in enumerate(columns)]
    )
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("missing"), F.col("_total").alias("total"))
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*entries)))


def outcome_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def class_counts(samples: DataFrame, by: str = "phase") -> DataFrame:
    """Samples, storms and quiet ones per split."""
    counts = samples.groupBy(by).agg(
        F.count("*").alias("samples"), F.coalesce(F.sum(F.col("label").cast("bigint")), F.lit(0)).alias("storm")
    )
    return counts.withColumn("quiet", F.col("samples") - F.col("storm"))


def run_totals(files: DataFrame, *by: str) -> DataFrame:
    """Totals per group and over everything (the group columns NULL there).

    ``files`` has one row per file with ``parsed`` (boolean) and ``rows``.
    """
    return files.rollup(*by).agg(
        F.count("*").alias("files"),
        F.count_if(F.col("parsed")).alias("parsed"),
        F.count_if(~F.col("parsed")).alias("failed"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_inserted"),
    )


def table_status(tables: dict[str, DataFrame | None], when: dict[str, str | None]) -> DataFrame:
    """Presence, rows and time range of each declared table; absent ones are None."""
    reports = []
    any_frame = next(f for f in tables.values() if f is not None)
    for name, frame in tables.items():
        if frame is None:
            frame, there = any_frame.limit(0), False
        else:
            there = True
        column = when.get(name) if there else None
        time = F.col(column) if column else F.lit(None)
        reports.append(
            frame.agg(
                F.count("*").alias("n_rows"),
                F.min(time.cast("timestamp_ntz")).alias("first_time"),
                F.max(time.cast("timestamp_ntz")).alias("last_time"),
            ).select(
                F.lit(name).alias("table_name"), F.lit(there).alias("is_present"), "n_rows", "first_time", "last_time"
            )
        )
    return reduce(DataFrame.unionByName, reports)
