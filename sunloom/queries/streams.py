"""Streams over landing folders filled from the test tables."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.queries.inputs import mean_sql, table
from sunloom.session import scratch_path
from sunloom.sources.hpo import HP30
from sunloom.streaming.bins import bin_stats, compact_bins, stream_bins
from sunloom.streaming.flows import stream_nowcast, stream_register, stream_stats
from sunloom.tables import TABLES, ensure_tables, read_table


def _finish(query) -> None:
    query.awaitTermination()


def nowcast_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping rolling texts: each half hour of the events is stored once."""
    line = F.expr(
        """format_string('%04d %02d %02d %04.1f 0 0 0 %d %d 1', year(ts), month(ts), day(ts),
             hour(ts) + IF(minute(ts) >= 30, 0.5D, 0.0D), day(ts) % 9, CAST(hour(ts) AS INT))"""
    )
    lines = table(spark, sf_dir, "events").select(line.alias("value"), "ts")
    landing, root, state = (scratch_path(spark, n) for n in ("landing", "nowcast", "state"))
    ensure_tables(spark, root, [TABLES[HP30.table]])
    for part in (lines.where("day(ts) < 20"), lines.where("day(ts) >= 10")):
        part.select("value").write.mode("append").text(landing)
        _finish(stream_nowcast(spark, landing, HP30, root, state, once=True))
    stored = read_table(spark, root, TABLES[HP30.table])
    return stored.select("datetime", *[F.col(c).cast("double").alias(c) for c in ("hh_start", "hp30", "ap30")])


SQL_NOWCAST = """
WITH bins AS (SELECT DISTINCT time_bucket(INTERVAL 30 MINUTE, ts) AS datetime FROM events)
SELECT datetime, hour(datetime) + minute(datetime) / 60.0::DOUBLE AS hh_start, (day(datetime) % 9)::DOUBLE AS hp30,
  hour(datetime)::DOUBLE AS ap30 FROM bins
"""


def register_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files arriving twice are registered once."""
    records = table(spark, sf_dir, "events").selectExpr(
        "CAST(16 + user_id % 3 AS SMALLINT) AS satellite", "date_trunc('hour', ts)::timestamp_ntz AS datetime",
        "CAST(hour(ts) AS DOUBLE) AS bx_nt", "event_id",
    )
    landing, root, state = (scratch_path(spark, n) for n in ("arrivals", "catalog", "state"))
    for part in (records.where("event_id % 2 = 0"), records):
        part.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(records.schema).parquet(landing)
        _finish(stream_register(stream, TABLES["goes_mag"], root, ("event_id",), state, once=True))
    return read_table(spark, root, TABLES["goes_mag"]).select(
        F.col("satellite").cast("int").alias("satellite"), "datetime", F.col("bx_nt").cast("double").alias("bx_nt")
    )


SQL_REGISTER = """
SELECT DISTINCT (16 + user_id % 3)::INTEGER AS satellite, date_trunc('hour', ts)::TIMESTAMP AS datetime,
  hour(ts)::DOUBLE AS bx_nt FROM events
"""


def tumbling_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-hourly statistics of the bins closed when the stream ends."""
    events = table(spark, sf_dir, "events")
    landing, out, state = (scratch_path(spark, n) for n in ("rows", "stats", "state"))
    events.select(F.col("ts").alias("datetime"), "value").write.parquet(landing)
    rows = spark.readStream.schema("datetime timestamp_ntz, value double").parquet(landing)
    _finish(
        stream_stats(
            rows, {"value": F.col("value")}, timedelta(minutes=30), timedelta(hours=1), out, state, True
        )
    )
    return spark.read.parquet(out)


SQL_TUMBLING = f"""
SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS datetime, {mean_sql('value')} AS value_avg, min(value) AS value_min,
  max(value) AS value_max
FROM events GROUP BY 1
HAVING time_bucket(INTERVAL 30 MINUTE, min(ts)) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
"""

def late_rows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bin of the events, a third of which arrive after the watermark has passed them.

    Partials are folded between the arrivals; late rows count by bin.
    """
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("datetime"), "value")
    landing, out, state = (scratch_path(spark, n) for n in ("rows", "bins", "state"))
    for part in ("event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2"):
        events.where(part).select("datetime", "value").write.mode("append").parquet(landing)
        rows = spark.readStream.schema("datetime timestamp_ntz, value double").parquet(landing)
        _finish(stream_bins(rows, {"value": F.col("value")}, timedelta(minutes=30), timedelta(hours=1), out, state, True))
        compact_bins(spark, out, ["value"])
    return bin_stats(spark, out, ["value"])


SQL_LATE = f"""
WITH marks AS (
  SELECT k, (SELECT max(ts) FROM events WHERE event_id % 3 < k) - INTERVAL 1 HOUR AS mark FROM range(3) r(k)
),
placed AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS bin, ts, value, mark FROM events JOIN marks ON k = event_id % 3
)
SELECT bin AS datetime, {mean_sql('value')} AS value_avg, min(value) AS value_min, max(value) AS value_max,
  count(*) AS rows, count(*) FILTER (bin + INTERVAL 30 MINUTE <= mark) AS late_rows
FROM placed GROUP BY 1
"""

QUERIES = {
    "late_rows_stream": late_rows_stream,
    "nowcast_stream": nowcast_stream,
    "register_stream": register_stream,
    "tumbling_stream": tumbling_stream,
}
ORACLES = {
    "late_rows_stream": SQL_LATE,
    "nowcast_stream": SQL_NOWCAST,
    "register_stream": SQL_REGISTER,
    "tumbling_stream": SQL_TUMBLING,
}
