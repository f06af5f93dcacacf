"""The 30-minute solar-wind and index table."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunloom.functions.times import DAY, micros, ntz
from sunloom.operators.grids import time_grid
from sunloom.operators.resample import align_to_grid, tumbling_stats
from sunloom.sinks.tables import replace_years
from sunloom.tables import SOLAR_WIND_VARIABLES, SW30_COLUMNS, TABLES

HALF_HOUR = timedelta(minutes=30)


def build_sw30(
    minutes: DataFrame, index: DataFrame, start: datetime, end: datetime
) -> DataFrame:
    """Mean, minimum and maximum of seven variables per half hour, with the indices.

    Every half hour from ``start`` to ``end`` appears once. ``start`` must lie on
    a half hour, since bins are counted from midnight.
    """
    midnight = datetime(start.year, start.month, start.day)
    if micros(start - midnight) % micros(HALF_HOUR):
        raise ValueError(f"{start} is not on a half hour")
    when = F.col("datetime")
    held = minutes.where((when >= ntz(start)) & (when < ntz(end + HALF_HOUR)))
    variables = {short: F.col(source) for short, source in SOLAR_WIND_VARIABLES.items()}
    stats = tumbling_stats(held, variables, HALF_HOUR)
    dense = align_to_grid(time_grid(minutes.sparkSession, start, end, HALF_HOUR), stats)
    indices = index.where(when.between(ntz(start), ntz(end))).select("datetime", "ap30", "hp30")
    return dense.join(indices, "datetime", "left").select(*SW30_COLUMNS)


def rebuild_years(
    minutes: DataFrame, index: DataFrame, first: int, last: int, root: str
) -> None:
    """Build all years in one job and replace them in the stored table."""
    table = build_sw30(minutes, index, datetime(first, 1, 1), datetime(last, 12, 31, 23, 30))
    replace_years(table, TABLES["sw_30min"], root)
