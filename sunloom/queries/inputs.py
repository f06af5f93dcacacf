"""Views of the test tables in the shape the library works on, for Spark and for SQL."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.times import floor_time, micros
from sunloom.operators.resample import tumbling_stats
from sunloom.plans.sw30 import HALF_HOUR
from sunloom.session import apply_settings
from sunloom.tables import SOLAR_WIND_VARIABLES


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Rows of one task where a record is costly to make or to parse.
ROWS_PER_TASK = 50_000


def shares(df: DataFrame) -> int:
    """Tasks for the rows of a table: as many as cores, more for a larger table."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_PER_TASK))


def spread(df: DataFrame) -> DataFrame:
    """Share rows out evenly where a table comes as few splits, or as splits of unlike numbers
    of rows, but its records are costly to make."""
    return df.repartition(shares(df))


# Solar-wind variable -> condition on an event.
VARIABLE_CONDITIONS = {
    "v": "event_type = 'click'",
    "np": "event_type = 'view'",
    "t": "event_type = 'purchase'",
    "bx": "event_type = 'error'",
    "by": "event_type = 'signup'",
    "bz": "user_id % 2 = 0",
    "bt": "true",
}


def minute_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("ts").alias("datetime"),
        *[
            F.expr(f"CASE WHEN {VARIABLE_CONDITIONS[short]} THEN value END").alias(source)
            for short, source in SOLAR_WIND_VARIABLES.items()
        ],
    )


def index_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly index: sign-ups of the bin, and their largest value."""
    events = table(spark, sf_dir, "events").where("event_type = 'signup'")
    bins = events.select(floor_time(F.col("ts"), micros(HALF_HOUR)).alias("datetime"), "value")
    return bins.groupBy("datetime").agg(
        F.count("*").cast("double").alias("ap30"), F.max("value").alias("hp30")
    )


def first_and_last(frame: DataFrame, column: str) -> tuple[datetime, datetime]:
    return tuple(frame.agg(F.min(column), F.max(column)).first())


def half_hours(spark: SparkSession, sf_dir: str) -> tuple[datetime, datetime]:
    """From the first midnight to the last half hour with data."""
    lo, hi = first_and_last(table(spark, sf_dir, "events"), "ts")
    start = datetime(lo.year, lo.month, lo.day)
    return start, start + ((hi - start) // HALF_HOUR) * HALF_HOUR


SQL_BINS = """
bounds AS (
  SELECT date_trunc('day', min(ts))::TIMESTAMP AS lo, time_bucket(INTERVAL 30 MINUTE, max(ts)) AS hi FROM events
),
grid AS (SELECT unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS datetime FROM bounds)
"""


def mean_sql(value: str) -> str:
    return f"sum(CAST({value} AS DECIMAL(18,2)))::DOUBLE / nullif(count({value}), 0)"


def image_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'aia' ELSE 'hmi' END AS telescope",
        "concat('c', user_id % 7) AS channel",
        "ts AS datetime",
        "concat('f/', event_id) AS file_path",
        "event_id % 3 AS quality",
    )


SQL_CATALOG = """
catalog AS (
  SELECT CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 'aia' ELSE 'hmi' END AS telescope,
         'c' || (user_id % 7) AS channel, ts AS datetime, 'f/' || event_id AS file_path, event_id % 3 AS quality
  FROM events
)
"""


def dense_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly grid with one averaged variable and an index of events per bin."""
    from sunloom.operators.grids import time_grid
    from sunloom.operators.resample import align_to_grid

    events = table(spark, sf_dir, "events").select(F.col("ts").alias("datetime"), "value")
    stats = tumbling_stats(events, {"bt": F.col("value")}, HALF_HOUR)
    bins = floor_time(F.col("datetime"), micros(HALF_HOUR)).alias("datetime")
    index = events.select(bins).groupBy("datetime").agg(F.count("*").cast("double").alias("ap30"))
    grid = time_grid(spark, *half_hours(spark, sf_dir), HALF_HOUR)
    return align_to_grid(align_to_grid(grid, stats), index)


SQL_DENSE = SQL_BINS + f""",
dense AS (
  SELECT datetime, bt_avg, bt_min, bt_max, ap30 FROM grid LEFT JOIN (
    SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS datetime, {mean_sql('value')} AS bt_avg,
           min(value) AS bt_min, max(value) AS bt_max, count(*)::DOUBLE AS ap30
    FROM events GROUP BY 1) USING (datetime)
)
"""


def days(n: float) -> timedelta:
    return timedelta(days=n)
