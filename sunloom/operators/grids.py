"""Dense time grids and option grids."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.times import HOUR, micros, ntz, plus_micros, round_hour


def time_grid(spark: SparkSession, start: datetime, end: datetime, step: timedelta) -> DataFrame:
    """``datetime`` from ``start`` to ``end``, both included; made in parallel."""
    count = max((end - start) // step + 1, 0)
    offset = F.col("id") * F.lit(micros(step))
    return spark.range(count).select(plus_micros(ntz(start), offset).alias("datetime"))


def hourly_targets(spans: DataFrame, start: str, end: str, name: str = "target_time") -> DataFrame:
    """Whole hours of every span, both ends rounded to the nearest hour."""
    first, last = round_hour(F.col(start)), round_hour(F.col(end))
    hours = F.when(first <= last, F.sequence(first, last, F.make_dt_interval(hours=F.lit(HOUR // HOUR))))
    return spans.withColumn(name, F.explode(hours))


def months(spans: DataFrame, start: str, end: str) -> DataFrame:
    """``year`` and ``month`` of every calendar month a span touches."""
    first, last = (F.trunc(F.col(c).cast("date"), "MM") for c in (start, end))
    steps = F.when(first <= last, F.sequence(first, last, F.make_ym_interval(F.lit(0), F.lit(1))))
    each = spans.withColumn("_month", F.explode(steps))
    return each.withColumn("year", F.year("_month")).withColumn("month", F.month("_month")).drop("_month")


def days(spans: DataFrame, start: str, end: str, name: str = "day") -> DataFrame:
    first, last = F.col(start).cast("date"), F.col(end).cast("date")
    steps = F.when(first <= last, F.sequence(first, last, F.make_dt_interval(F.lit(1))))
    return spans.withColumn(name, F.explode(steps))


def with_options(df: DataFrame, **choices: Sequence[str]) -> DataFrame:
    """Every row with every combination of the listed values; no join."""
    for name, values in choices.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


def in_ranges(df: DataFrame, when: str, ranges: dict[str, tuple[Column, Column]], name: str = "phase") -> DataFrame:
    """One copy of a row per closed range that holds its time; ranges may overlap."""
    entries = [
        F.struct(F.lit(label).alias("label"), lo.alias("lo"), hi.alias("hi")) for label, (lo, hi) in ranges.items()
    ]
    held = F.filter(F.array(*entries), lambda r: (F.col(when) >= r["lo"]) & (F.col(when) <= r["hi"]))
    return df.withColumn(name, F.explode(F.transform(held, lambda r: r["label"])))
