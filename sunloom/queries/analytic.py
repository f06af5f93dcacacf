"""Aggregation, time matches, event windows, labelled samples."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.times import ntz
from sunloom.operators.grids import hourly_targets
from sunloom.operators.quality import class_counts, null_report
from sunloom.operators.resample import tumbling_stats
from sunloom.operators.timejoin import covered, nearest_matches, nearest_record
from sunloom.plans import samples
from sunloom.plans.images import good_quality
from sunloom.plans.sw30 import build_sw30, rebuild_years
from sunloom.queries.inputs import (
    SQL_BINS,
    SQL_CATALOG,
    SQL_DENSE,
    VARIABLE_CONDITIONS,
    days,
    dense_table,
    half_hours,
    image_catalog,
    index_series,
    mean_sql,
    minute_series,
    table,
)
from sunloom.session import scratch_path
from sunloom.tables import SW30_COLUMNS, TABLES, read_table

DIMS = ("telescope", "channel")


def sw30_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = half_hours(spark, sf_dir)
    return build_sw30(minute_series(spark, sf_dir), index_series(spark, sf_dir), start, end)


_SW30_STATS = ",\n".join(
    f"{mean_sql(f'CASE WHEN {c} THEN value END')} AS {s}_avg, "
    f"min(CASE WHEN {c} THEN value END) AS {s}_min, max(CASE WHEN {c} THEN value END) AS {s}_max"
    for s, c in VARIABLE_CONDITIONS.items()
)
_SW30_PARTS = f"""
stats AS (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS datetime, {_SW30_STATS} FROM events GROUP BY 1),
idx AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS datetime, count(*)::DOUBLE AS ap30, max(value) AS hp30
  FROM events WHERE event_type = 'signup' GROUP BY 1
)
"""
SQL_SW30_BUILD = f"""
WITH {SQL_BINS}, {_SW30_PARTS}
SELECT {', '.join(SW30_COLUMNS)} FROM grid LEFT JOIN stats USING (datetime) LEFT JOIN idx USING (datetime)
"""


def sw30_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole years rebuilt twice into the stored table, then read back."""
    minutes, index = minute_series(spark, sf_dir), index_series(spark, sf_dir)
    years = minutes.agg(F.year(F.min("datetime")), F.year(F.max("datetime"))).first()
    root = scratch_path(spark, "sw30")
    for _ in range(2):
        rebuild_years(minutes, index, *years, root)
    stored = read_table(spark, root, TABLES["sw_30min"]).drop("datetime_year")
    return stored.withColumn("ap30", F.col("ap30").cast("double"))


SQL_SW30_STORED = f"""
WITH bounds AS (SELECT year(min(ts)) AS y0, year(max(ts)) AS y1 FROM events),
grid AS (
  SELECT unnest(generate_series(make_timestamp(y0, 1, 1, 0, 0, 0), make_timestamp(y1, 12, 31, 23, 30, 0),
                                INTERVAL 30 MINUTE)) AS datetime FROM bounds
), {_SW30_PARTS}
SELECT datetime, {', '.join(f'CAST({c} AS {"DOUBLE" if c == "ap30" else "FLOAT"}) AS {c}' for c in SW30_COLUMNS[1:])}
FROM grid LEFT JOIN stats USING (datetime) LEFT JOIN idx USING (datetime)
"""


def tumbling_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumnRenamed("ts", "datetime")
    return tumbling_stats(events, {"value": F.col("value")}, timedelta(hours=1), by=("event_type",))


SQL_TUMBLING = f"""
SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS datetime, {mean_sql('value')} AS value_avg,
       min(value) AS value_min, max(value) AS value_max
FROM events GROUP BY 1, 2
"""


def null_report_sw30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_report(sw30_build(spark, sf_dir))


SQL_NULL_REPORT = f"""
WITH {SQL_BINS}, {_SW30_PARTS},
built AS (
  SELECT {', '.join(SW30_COLUMNS)} FROM grid LEFT JOIN stats USING (datetime) LEFT JOIN idx USING (datetime)
)
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing, count(*) AS total FROM built" for c in SW30_COLUMNS
)


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours between the first and last image of each telescope and channel."""
    spans = image_catalog(spark, sf_dir).groupBy(*DIMS).agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
    return hourly_targets(spans, "lo", "hi").select(*DIMS, "target_time")


_SQL_TARGETS = SQL_CATALOG + """,
spans AS (
  SELECT telescope, channel, date_trunc('hour', min(datetime) + INTERVAL 30 MINUTE) AS lo,
         date_trunc('hour', max(datetime) + INTERVAL 30 MINUTE) AS hi
  FROM catalog GROUP BY 1, 2
),
targets AS (SELECT telescope, channel, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS target_time FROM spans)
"""
SQL_HOURLY = f"WITH {_SQL_TARGETS} SELECT telescope, channel, target_time FROM targets"


def best_match_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = good_quality(image_catalog(spark, sf_dir))
    return nearest_matches(hourly(spark, sf_dir), held, DIMS, timedelta(minutes=30), ("file_path",))


SQL_BEST_MATCH = f"""
WITH {_SQL_TARGETS},
pairs AS (
  SELECT t.*, c.datetime, c.file_path, c.quality, abs(epoch_us(c.datetime) - epoch_us(t.target_time)) AS gap_us
  FROM targets t JOIN catalog c ON c.telescope = t.telescope AND c.channel = t.channel AND c.quality = 0
   AND c.datetime BETWEEN t.target_time - INTERVAL 30 MINUTE AND t.target_time + INTERVAL 30 MINUTE
)
SELECT telescope, channel, target_time, datetime, gap_us, file_path, quality FROM pairs
QUALIFY row_number() OVER (PARTITION BY telescope, channel, target_time ORDER BY gap_us, datetime, file_path) = 1
"""


def best_match_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sign-up matched to the nearest other event of the same user group."""
    events = table(spark, sf_dir, "events").selectExpr(
        "user_id % 3 AS grp", "event_type", "ts AS datetime", "event_id"
    )
    targets = events.where("event_type = 'signup'").selectExpr("event_id AS target_id", "grp", "datetime AS target_time")
    records = events.where("event_type <> 'signup'").drop("event_type")
    near = nearest_matches(targets, records, ("grp",), timedelta(minutes=10), ("event_id",), slots=64, how="left")
    return near.withColumns({c: F.col(c).cast("double") for c in ("gap_us", "event_id")})


SQL_BEST_DENSE = """
WITH e AS (SELECT user_id % 3 AS grp, event_type, ts AS datetime, event_id FROM events),
targets AS (SELECT event_id AS target_id, grp, datetime AS target_time FROM e WHERE event_type = 'signup'),
pairs AS (
  SELECT t.target_id, r.datetime, r.event_id, abs(epoch_us(r.datetime) - epoch_us(t.target_time)) AS gap_us
  FROM targets t JOIN e r ON r.event_type <> 'signup' AND r.grp = t.grp
   AND r.datetime BETWEEN t.target_time - INTERVAL 10 MINUTE AND t.target_time + INTERVAL 10 MINUTE
),
best AS (
  SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY target_id ORDER BY gap_us, datetime, event_id) = 1
)
SELECT target_id, grp, target_time, datetime, gap_us::DOUBLE AS gap_us, event_id::DOUBLE AS event_id
FROM targets LEFT JOIN best USING (target_id)
"""

_TARGET = datetime(2024, 1, 15, 12, 0)


def best_match_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    catalog = good_quality(image_catalog(spark, sf_dir))
    wanted = (F.col("telescope") == "aia") & (F.col("channel") == "c3")
    return nearest_record(catalog, ntz(_TARGET), timedelta(hours=6), ("file_path",), wanted)


SQL_BEST_ONE = f"""
WITH {SQL_CATALOG}
SELECT *, abs(epoch_us(datetime) - epoch_us(TIMESTAMP '{_TARGET}')) AS gap_us FROM catalog
WHERE telescope = 'aia' AND channel = 'c3' AND quality = 0
  AND datetime BETWEEN TIMESTAMP '{_TARGET}' - INTERVAL 6 HOUR AND TIMESTAMP '{_TARGET}' + INTERVAL 6 HOUR
ORDER BY gap_us, datetime, file_path LIMIT 1
"""


def _coverage(spark: SparkSession, sf_dir: str, inverted: bool) -> DataFrame:
    held = good_quality(image_catalog(spark, sf_dir))
    return covered(hourly(spark, sf_dir), held, DIMS, timedelta(minutes=6), inverted=inverted)


def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir, True)


def coverage_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir, False)


_SQL_COVERAGE = f"""
WITH {_SQL_TARGETS}
SELECT telescope, channel, target_time FROM targets t WHERE {{}} EXISTS (
  SELECT 1 FROM catalog c WHERE c.telescope = t.telescope AND c.channel = t.channel AND c.quality = 0
   AND c.datetime BETWEEN t.target_time - INTERVAL 6 MINUTE AND t.target_time + INTERVAL 6 MINUTE)
"""


def event_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = half_hours(spark, sf_dir)
    return samples.event_windows(
        dense_table(spark, sf_dir), start + days(1), end - days(1), timedelta(hours=3), days(1), days(1)
    )


SQL_EVENT_WINDOWS = f"""
WITH {SQL_DENSE},
refs AS (
  SELECT unnest(generate_series(lo + INTERVAL 1 DAY, hi - INTERVAL 1 DAY, INTERVAL 3 HOUR)) AS reference_time
  FROM bounds
),
rows_in AS (
  SELECT reference_time, d.* FROM refs JOIN dense d
   ON d.datetime BETWEEN reference_time - INTERVAL 1 DAY AND reference_time + INTERVAL 1 DAY - INTERVAL 30 MINUTE
)
SELECT reference_time, row_number() OVER (PARTITION BY reference_time ORDER BY datetime)::INTEGER AS position,
       datetime, bt_avg, bt_min, bt_max, ap30
FROM rows_in
QUALIFY bool_and(bt_avg IS NOT NULL AND ap30 IS NOT NULL) OVER (PARTITION BY reference_time)
"""


def event_window_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.event_window(dense_table(spark, sf_dir), _TARGET)


SQL_EVENT_ONE = f"""
WITH {SQL_DENSE}
SELECT * FROM dense WHERE datetime BETWEEN TIMESTAMP '{_TARGET}' - INTERVAL 5 DAY
  AND TIMESTAMP '{_TARGET}' + INTERVAL 3 DAY - INTERVAL 30 MINUTE
"""

_THRESHOLD = 12


def sample_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.sample_index(dense_table(spark, sf_dir), threshold=_THRESHOLD)


def _sql_judged(before: int, after: int, cadence: int) -> str:
    return f"""{SQL_DENSE},
windowed AS (
  SELECT datetime, row_number() OVER (ORDER BY datetime) - 1 AS i, count(*) OVER () AS n,
    sum(CASE WHEN bt_avg IS NULL OR ap30 IS NULL THEN 1 ELSE 0 END)
      OVER (ORDER BY datetime ROWS BETWEEN {before} PRECEDING AND {after - 1} FOLLOWING) AS bad,
    max(ap30) OVER (ORDER BY datetime ROWS BETWEEN CURRENT ROW AND {after - 1} FOLLOWING) AS peak,
    min(datetime) OVER () + INTERVAL {cadence * before} MINUTE AS lo,
    max(datetime) OVER () - INTERVAL {cadence * after} MINUTE AS hi
  FROM dense
),
judged AS (
  SELECT datetime, CASE WHEN i < {before} OR i + {after} > n THEN 'no_window' WHEN bad > 0 THEN 'missing_values'
         ELSE 'valid' END AS status, (peak::FLOAT >= {_THRESHOLD}::FLOAT)::INTEGER AS label, lo, hi
  FROM windowed
  WHERE datetime BETWEEN lo AND hi AND (epoch_us(datetime) - epoch_us(lo)) % {cadence * 60_000_000} = 0
)
"""


SQL_SAMPLE_INDEX = f"WITH {_sql_judged(240, 144, 30)} SELECT datetime, label FROM judged WHERE status = 'valid'"


def sample_index_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly cadence: the candidate range then spans twice the window."""
    return samples.sample_index(
        dense_table(spark, sf_dir), cadence=timedelta(hours=1), before=48, after=24, threshold=_THRESHOLD
    )


SQL_SAMPLE_HOURLY = f"WITH {_sql_judged(48, 24, 60)} SELECT datetime, label FROM judged WHERE status = 'valid'"


def sample_skip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.skip_counts(dense_table(spark, sf_dir), before=48, after=24, threshold=_THRESHOLD)


SQL_SKIPS = f"""
WITH {_sql_judged(48, 24, 30)},
c AS (
  SELECT count(*) FILTER (status = 'valid') AS valid, count(*) FILTER (status = 'missing_values') AS nulls FROM judged
),
t AS (
  SELECT greatest((epoch_us(max(datetime)) - epoch_us(min(datetime)) - {72 * 1_800_000_000}) // 1800000000 + 1, 0) AS total
  FROM dense
)
SELECT 'valid' AS status, valid AS n FROM c UNION ALL SELECT 'missing_values', nulls FROM c
UNION ALL SELECT 'missing', total - valid - nulls FROM c, t
"""

_SPLITS = {
    "train": (date(2024, 1, 1), date(2024, 1, 14)),
    "validation": (date(2024, 1, 15), date(2024, 1, 21)),
    "test": (date(2024, 1, 20), date(2024, 1, 31)),
}


def sample_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = samples.sample_index(dense_table(spark, sf_dir), before=48, after=24, threshold=_THRESHOLD)
    return samples.split_samples(found, _SPLITS)


def split_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_counts(sample_splits(spark, sf_dir))


_SQL_SPLITS = f"""{_sql_judged(48, 24, 30)},
splits(phase, s, e) AS (VALUES {', '.join(
    f"('{p}', TIMESTAMP '{s} 00:00:00', TIMESTAMP '{e} 23:59:59')" for p, (s, e) in _SPLITS.items())}),
split AS (
  SELECT datetime, label, phase FROM judged JOIN splits ON datetime BETWEEN s AND e WHERE status = 'valid'
)
"""
SQL_SPLITS = f"WITH {_SQL_SPLITS} SELECT datetime, label, phase FROM split"
SQL_CLASS_COUNTS = f"""
WITH {_SQL_SPLITS}
SELECT phase, count(*) AS samples, sum(label)::BIGINT AS storm, count(*) - sum(label)::BIGINT AS quiet
FROM split GROUP BY phase
"""

QUERIES = {
    "sw30_build": sw30_build,
    "sw30_stored": sw30_stored,
    "tumbling_by_type": tumbling_by_type,
    "null_report": null_report_sw30,
    "hourly_targets": hourly,
    "best_match_hourly": best_match_hourly,
    "best_match_dense": best_match_dense,
    "best_match_one": best_match_one,
    "coverage_gaps": coverage_gaps,
    "coverage_hits": coverage_hits,
    "event_windows": event_windows,
    "event_window_one": event_window_one,
    "sample_index": sample_index,
    "sample_index_hourly": sample_index_hourly,
    "sample_skip_counts": sample_skip_counts,
    "sample_splits": sample_splits,
    "split_class_counts": split_class_counts,
}
ORACLES = {
    "sw30_build": SQL_SW30_BUILD,
    "sw30_stored": SQL_SW30_STORED,
    "tumbling_by_type": SQL_TUMBLING,
    "null_report": SQL_NULL_REPORT,
    "hourly_targets": SQL_HOURLY,
    "best_match_hourly": SQL_BEST_MATCH,
    "best_match_dense": SQL_BEST_DENSE,
    "best_match_one": SQL_BEST_ONE,
    "coverage_gaps": _SQL_COVERAGE.format("NOT"),
    "coverage_hits": _SQL_COVERAGE.format(""),
    "event_windows": SQL_EVENT_WINDOWS,
    "event_window_one": SQL_EVENT_ONE,
    "sample_index": SQL_SAMPLE_INDEX,
    "sample_index_hourly": SQL_SAMPLE_HOURLY,
    "sample_skip_counts": SQL_SKIPS,
    "sample_splits": SQL_SPLITS,
    "split_class_counts": SQL_CLASS_COUNTS,
}
