"""Writes, exports, clean-up and status: what the stored files hold afterwards."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.operators.inserts import accept_in_order
from sunloom.operators.quality import table_status
from sunloom.plans.samples import split_samples
from sunloom.plans.status import stored_status
from sunloom.queries import analytic
from sunloom.queries.inputs import table
from sunloom.session import scratch_path
from sunloom.sinks.exports import (
    CSV_EXPORTS,
    export_events,
    export_index,
    export_parquet,
    export_tables,
    manifest_documents,
    write_manifests,
)
from sunloom.sinks.tables import (
    append_rows,
    compact,
    delete_orphans,
    insert_ignore,
    new_rows,
    orphan_rows,
    replace_years,
)
from sunloom.sources.files import read_manifest
from sunloom.tables import TABLES, TableSpec, ensure_tables, read_table, table_path
from sunloom.versions import latest

ORDERS_BY_YEAR = TableSpec(
    "orders_by_year",
    T.StructType(
        [
            T.StructField("o_orderkey", T.LongType(), False),
            T.StructField("datetime", T.TimestampNTZType(), False),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    ),
    ("o_orderkey",),
)
LINES = TableSpec(
    "lines", T.StructType([T.StructField("l_orderkey", T.LongType(), False)]), ("l_orderkey",)
)


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("datetime"), "o_totalprice")


def replaced_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two of the years are replaced by half of their orders at double price."""
    orders, root = _dated_orders(spark, sf_dir), scratch_path(spark, "replace")
    replace_years(orders, ORDERS_BY_YEAR, root)
    fresh = orders.where(F.year("datetime").isin(1996, 1998) & (F.col("o_orderkey") % 2 == 0))
    replace_years(fresh.withColumn("o_totalprice", F.col("o_totalprice") * 2), ORDERS_BY_YEAR, root)
    return read_table(spark, root, ORDERS_BY_YEAR).drop("datetime_year")


SQL_REPLACED = """
SELECT o_orderkey, o_orderdate AS datetime,
  CASE WHEN year(o_orderdate) IN (1996, 1998) THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice
FROM orders WHERE year(o_orderdate) NOT IN (1996, 1998) OR o_orderkey % 2 = 0
"""


def appended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, one of rows without a time, which are refused and counted."""
    orders, root = _dated_orders(spark, sf_dir), scratch_path(spark, "append")
    append_rows(orders.where("o_orderkey % 2 = 0"), ORDERS_BY_YEAR, root)
    holed = orders.where("o_orderkey % 2 = 1").withColumn(
        "datetime", F.when(F.col("o_orderkey") % 3 != 0, F.col("datetime"))
    )
    refused = append_rows(holed, ORDERS_BY_YEAR, root)
    stored = read_table(spark, root, ORDERS_BY_YEAR).select("o_orderkey", F.lit("stored").alias("fate"))
    return stored.unionByName(refused.select("o_orderkey", F.col("error").alias("fate")))


SQL_APPENDED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 THEN 'missing_key' ELSE 'stored' END AS fate
FROM orders
"""

def duplicate_keys_refused(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the orders replace years, each line of one being a row; the rest is appended
    with rows already stored. The fate of each line."""
    lines = table(spark, sf_dir, "lineitem").join(_dated_orders(spark, sf_dir), F.expr("l_orderkey = o_orderkey"))
    rows = lines.select("o_orderkey", "datetime", F.col("l_linenumber").cast("double").alias("o_totalprice"))
    root = scratch_path(spark, "duplicates")
    refused = replace_years(rows.where("o_orderkey % 2 = 0"), ORDERS_BY_YEAR, root, ("o_totalprice",))
    more = append_rows(rows.where("o_orderkey % 4 <> 2"), ORDERS_BY_YEAR, root, ("o_totalprice",))
    stored = read_table(spark, root, ORDERS_BY_YEAR).select("o_orderkey", "o_totalprice", F.lit("stored").alias("fate"))
    for frame in (refused, more):
        stored = stored.unionByName(frame.select("o_orderkey", "o_totalprice", F.col("error").alias("fate")))
    return stored.groupBy("o_orderkey", "fate").agg(F.count("*").alias("n"), F.min("o_totalprice").alias("first_line"))


SQL_DUPLICATES = """
WITH rows AS (
  SELECT o_orderkey, l_linenumber::DOUBLE AS line, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber) AS r
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
fates AS (
  SELECT o_orderkey, line, CASE WHEN r = 1 THEN 'stored' ELSE 'duplicate_key' END AS fate FROM rows
  UNION ALL
  SELECT o_orderkey, line, 'duplicate_key' FROM rows WHERE o_orderkey % 4 = 0
)
SELECT o_orderkey, fate, count(*) AS n, min(line) AS first_line FROM fates GROUP BY ALL
"""

_LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def insert_ignore_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First line of each order not yet stored; every second order is stored."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_LINE_ORDER)
    stored = table(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("l_orderkey"))
    return new_rows(lines, stored, LINES, _LINE_ORDER)


SQL_INSERT_IGNORE = f"""
SELECT l_orderkey, {', '.join(_LINE_ORDER)} FROM lineitem l
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey = l.l_orderkey)
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)}) = 1
"""


def insert_ignore_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key and path both unique: in each three events the second meets the first's
    path and the third meets the second's key, so the first and third get in."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('k', event_id div 3 * 2 + least(event_id % 3, 1)) AS k",
        "concat('p', event_id div 3 * 2 + greatest(event_id % 3 - 1, 0)) AS file_path",
        "user_id",
    )
    return accept_in_order(events, ("k",), "file_path", "event_id").select("event_id", "k", "file_path", "user_id")


SQL_UNIQUE = """
SELECT event_id, 'k' || (event_id // 3 * 2 + least(event_id % 3, 1)) AS k,
  'p' || (event_id // 3 * 2 + greatest(event_id % 3 - 1, 0)) AS file_path, user_id
FROM events WHERE event_id % 3 <> 1
"""


def insert_ignore_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the batch has one key and another third one path."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE concat('k', event_id) END AS k",
        "CASE WHEN event_id % 3 = 1 THEN 'hot' ELSE concat('p', event_id) END AS file_path",
    )
    return accept_in_order(events, ("k",), "file_path", "event_id").select("event_id", "k", "file_path")


SQL_HOT = """
WITH e AS (
  SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'k' || event_id END AS k,
    CASE WHEN event_id % 3 = 1 THEN 'hot' ELSE 'p' || event_id END AS file_path FROM events
)
SELECT * FROM e WHERE event_id % 3 = 2 OR event_id IN (
  SELECT min(event_id) FROM e WHERE event_id % 3 = 0 UNION ALL SELECT min(event_id) FROM e WHERE event_id % 3 = 1)
"""


def insert_ignore_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain through all events: each has the key or the path of the one before."""
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('k', (event_id + 1) div 2) AS k", "concat('p', event_id div 2) AS file_path"
    )
    return accept_in_order(events, ("k",), "file_path", "event_id").select("event_id", "k", "file_path")


# The runs of ids without a gap are chains of their own.
SQL_CHAIN = """
WITH e AS (SELECT event_id, event_id - row_number() OVER (ORDER BY event_id) AS run FROM events),
  n AS (SELECT event_id, row_number() OVER (PARTITION BY run ORDER BY event_id) AS place FROM e)
SELECT event_id, 'k' || (event_id + 1) // 2 AS k, 'p' || event_id // 2 AS file_path FROM n WHERE place % 2 = 1
"""


def _mag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "16 + user_id % 3 AS satellite",
        "ts AS datetime",
        "value AS bx_nt",
        "CASE WHEN event_type <> 'error' THEN value * 2 END AS by_nt",
        "CASE WHEN user_id % 2 = 0 THEN 'EPN' END AS coord_frame",
        "user_id % 5 AS mag_flag",
        "event_id",
    )


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored magnetometer table through its CSV export, read back as text."""
    root, out = scratch_path(spark, "mag"), scratch_path(spark, "csv")
    insert_ignore(_mag_rows(spark, sf_dir), TABLES["goes_mag"], root, ("event_id",))
    failed = {name: error for name, error in export_tables(spark, root, out, ["goes_mag"]).items() if error}
    if failed:
        raise RuntimeError(str(failed))
    spec = TABLES["goes_mag"]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in spec.schema.fields])
    back = spark.read.schema(schema).option("header", "true").csv(f"{out}/goes_mag")
    return back.select(
        F.col("satellite").cast("int").alias("satellite"), "datetime", "bx_nt", "by_nt", "coord_frame",
        F.col("mag_flag").cast("double").alias("mag_flag"),
    )


SQL_CSV = """
SELECT (16 + user_id % 3)::INTEGER AS satellite, ts AS datetime, value::FLOAT AS bx_nt,
  CASE WHEN event_type <> 'error' THEN (value * 2)::FLOAT END AS by_nt,
  CASE WHEN user_id % 2 = 0 THEN 'EPN' END AS coord_frame, (user_id % 5)::DOUBLE AS mag_flag
FROM events QUALIFY row_number() OVER (PARTITION BY user_id % 3, ts ORDER BY event_id) = 1
"""


def _made(number: int, kind: T.DataType, form: str) -> str:
    """A value of column ``number`` made from an event; ``form`` is the engine's name of a text."""
    whole = f"(user_id + {number}) % {number % 7 + 3}"
    if isinstance(kind, T.BooleanType):
        return f"({whole} = 0)"
    if isinstance(kind, T.StringType):
        return f"CASE WHEN {whole} > 0 THEN CAST({whole} AS {form}) END"
    part = 0 if isinstance(kind, (T.ShortType, T.IntegerType)) else 0.25
    # Required columns have a value in each row.
    return f"({whole} + {part})" if number < 8 else f"CASE WHEN event_id % {number % 5 + 2} > 0 THEN {whole} + {part} END"


def _made_columns(name: str, form: str) -> dict[str, str]:
    spec = TABLES[name]
    out = {f.name: _made(i, f.dataType, form) for i, f in enumerate(spec.schema.fields)}
    fixed = {"datetime": "ts", "year": "year(ts)", "satellite": "16 + user_id % 3"}
    return out | {name: value for name, value in fixed.items() if name in out}


def _as_number(column: str, kind: T.DataType) -> str | None:
    if isinstance(kind, T.BooleanType):
        return f"CASE WHEN {column} = 't' THEN 1 ELSE 0 END"
    return None if isinstance(kind, (T.StringType, T.TimestampNTZType)) else column


def csv_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six tables stored and exported; what the files hold in each column."""
    root, out = scratch_path(spark, "six"), scratch_path(spark, "csv")
    events = table(spark, sf_dir, "events")

    def store(name: str) -> None:
        made = [f"{value} AS {column}" for column, value in _made_columns(name, "STRING").items()]
        insert_ignore(events.selectExpr("event_id", *made), TABLES[name], root, ("event_id",))

    with ThreadPoolExecutor(len(CSV_EXPORTS)) as pool:
        list(pool.map(store, [stored for stored, _, _ in CSV_EXPORTS]))
    failed = {name: error for name, error in export_tables(spark, root, out).items() if error}
    if failed:
        raise RuntimeError(str(failed))
    parts = []
    for stored, exported, _ in CSV_EXPORTS:
        fields = TABLES[stored].schema.fields
        schema = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        back = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").csv(f"{out}/{exported}")
        held = [
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.count(f.name).alias("n_values"),
                (F.expr(f"sum(CAST({number} AS DOUBLE))") if (number := _as_number(f.name, f.dataType)) else F.lit(None).cast("double"))
                .alias("total"),
            )
            for f in fields
        ]
        counted = back.agg(F.count("*").alias("n_rows"), F.array(*held).alias("held"))
        parts.append(counted.select(F.lit(exported).alias("export"), "n_rows", F.inline("held")))
    return reduce(DataFrame.unionByName, parts)


def _sql_csv_tables() -> str:
    parts = []
    for stored, exported, _ in CSV_EXPORTS:
        spec = TABLES[stored]
        made = ", ".join(f"{value} AS {name}" for name, value in _made_columns(stored, "VARCHAR").items())
        by = "user_id % 3, ts" if "satellite" in spec.columns else "ts"
        rows = f"SELECT {made} FROM events QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY event_id) = 1"
        for f in spec.schema.fields:
            value = f"{f.name}::INTEGER" if isinstance(f.dataType, T.BooleanType) else f.name
            total = f"sum({value})::DOUBLE" if _as_number(f.name, f.dataType) else "NULL::DOUBLE"
            parts.append(
                f"SELECT '{exported}' AS export, count(*) AS n_rows, '{f.name}' AS column_name, "
                f"count({f.name}) AS n_values, {total} AS total FROM ({rows})"
            )
    return " UNION ALL ".join(parts)


def parquet_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three weeks of the half-hourly table, exported and read back."""
    out = scratch_path(spark, "export")
    export_parquet(analytic.sw30_build(spark, sf_dir), out, date(2024, 1, 5), date(2024, 1, 25))
    return spark.read.parquet(out)


SQL_PARQUET = f"""
SELECT * FROM ({analytic.SQL_SW30_BUILD})
WHERE datetime BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-25 23:59:59'
"""


def event_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and span per exported event folder."""
    out = scratch_path(spark, "events")
    export_events(analytic.event_windows(spark, sf_dir), out)
    schema = "position int, datetime timestamp_ntz, bt_avg double, bt_min double, bt_max double, ap30 double, event_id string"
    back = spark.read.schema(schema).option("header", "true").csv(out)
    return back.groupBy("event_id").agg(
        F.count("*").alias("n"), F.min("datetime").alias("first_time"), F.max("datetime").alias("last_time"),
        F.sum(F.col("ap30").cast("bigint")).alias("sum_ap"), F.max("position").alias("last_position"),
    )


SQL_EVENT_CSV = f"""
SELECT strftime(reference_time, '%Y%m%d%H%M%S') AS event_id, count(*) AS n, min(datetime) AS first_time,
  max(datetime) AS last_time, sum(ap30::BIGINT)::BIGINT AS sum_ap, max(position) AS last_position
FROM ({analytic.SQL_EVENT_WINDOWS}) GROUP BY reference_time
"""


def index_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "index")
    export_index(split_samples(analytic.sample_index(spark, sf_dir), analytic._SPLITS), out)
    return spark.read.schema("datetime timestamp_ntz, label int, phase string").option("header", "true").csv(out)


SQL_INDEX_CSV = f"""
SELECT datetime, label, phase FROM ({analytic.SQL_SAMPLE_INDEX}) JOIN (VALUES {', '.join(
    f"('{p}', TIMESTAMP '{s} 00:00:00', TIMESTAMP '{e} 23:59:59')" for p, (s, e) in analytic._SPLITS.items())})
  AS splits(phase, s, e) ON datetime BETWEEN s AND e
"""


def manifest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per page group: channels to files, written as JSON and read back."""
    pages = table(spark, sf_dir, "pages").selectExpr(
        "TIMESTAMP_NTZ'2024-01-01 12:00:00' AS query_time",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, CAST(page_id div 20 AS INT)) AS target_time",
        "CASE WHEN page_id div 20 % 2 = 0 THEN 12 END AS time_range",
        "CASE WHEN page_id div 20 % 3 = 0 THEN 'hmi' END AS telescope",
        "CAST(page_id % 4 AS string) AS channel",
        "url",
        "CASE WHEN page_id % 7 <> 0 THEN concat('f', page_id, '.fits') END AS filename",
    )
    out = scratch_path(spark, "manifest")
    write_manifests(manifest_documents(pages), out)
    return read_manifest(spark, out, channels=("0", "2", "3"), one_per_file=False)


SQL_MANIFEST = """
SELECT TIMESTAMP '2024-01-01 12:00:00' AS query_time,
  TIMESTAMP '2024-01-01' + to_hours((page_id // 20)::INTEGER) AS target_time,
  CASE WHEN page_id // 20 % 2 = 0 THEN 12 ELSE 6 END::INTEGER AS time_range,
  CASE WHEN page_id // 20 % 3 = 0 THEN 'hmi' ELSE 'aia' END AS telescope, (page_id % 4)::VARCHAR AS channel, url,
  'f' || page_id || '.fits' AS filename
FROM pages WHERE page_id % 7 <> 0 AND page_id % 4 <> 1
"""


def _lasco_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('c', doc_id % 4 + 1) AS camera",
        "TIMESTAMP_NTZ'2020-01-01 00:00:00' + make_dt_interval(0, 0, CAST(doc_id AS INT)) AS datetime",
        "concat('/archive/', doc_id) AS file_path",
        "n_chars / 4.0D AS exposure_time",
        "lang AS filter",
    )


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").selectExpr("concat('/archive/', doc_id) AS path")


def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_rows(_lasco_rows(spark, sf_dir), _listing(spark, sf_dir)).select("camera", "datetime", "file_path")


_SQL_LASCO = """
SELECT 'c' || (doc_id % 4 + 1) AS camera, TIMESTAMP '2020-01-01' + to_minutes(doc_id::INTEGER) AS datetime,
  '/archive/' || doc_id AS file_path FROM documents d
"""
SQL_ORPHANS = f"{_SQL_LASCO} WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"


def orphans_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue stored, cleaned in place, and read."""
    root = scratch_path(spark, "lasco")
    append_rows(_lasco_rows(spark, sf_dir), TABLES["lasco"], root)
    delete_orphans(spark, TABLES["lasco"], root, _listing(spark, sf_dir))
    return read_table(spark, root, TABLES["lasco"]).select("camera", "datetime", "file_path")


SQL_ORPHANS_DELETED = f"{_SQL_LASCO} WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"

def table_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as of each version: half of it, all of it, compacted, without orphans."""
    root, spec, rows = scratch_path(spark, "versions"), TABLES["lasco"], _lasco_rows(spark, sf_dir)
    append_rows(rows.where("exposure_time % 0.5 = 0"), spec, root)
    append_rows(rows, spec, root)
    compact(spark, spec, root, most=1)
    delete_orphans(spark, spec, root, _listing(spark, sf_dir))
    numbers = range(1, latest(spark, table_path(root, spec.name)).number + 1)
    frames = [read_table(spark, root, spec, n).select("file_path", F.lit(n).alias("version")) for n in numbers]
    return reduce(DataFrame.unionByName, frames)


SQL_VERSIONS = f"""
WITH d AS (SELECT '/archive/' || doc_id AS file_path, n_chars, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS there FROM documents d)
SELECT file_path, version::INTEGER AS version FROM d, (VALUES (1), (2), (3), (4)) AS v(version)
WHERE version IN (2, 3) OR version = 1 AND n_chars % 2 = 0 OR version = 4 AND there
"""


def racing_inserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three writers at once insert overlapping thirds of the catalogue; nothing is stored twice."""
    root, spec, rows = scratch_path(spark, "racing"), TABLES["lasco"], _lasco_rows(spark, sf_dir)
    ensure_tables(spark, root, [spec])
    batches = [rows.where(F.col("exposure_time") * 4 % 4 != k).withColumn("n", F.col("file_path")) for k in range(3)]
    with ThreadPoolExecutor(3) as pool:
        counts = list(pool.map(lambda batch: insert_ignore(batch, spec, root, ("n",)), batches))
    stored = read_table(spark, root, spec).groupBy("camera", "datetime", "file_path").agg(F.count("*").alias("n"))
    return stored.withColumn("inserted", F.lit(sum(c.inserted for c in counts)).cast("bigint"))


SQL_RACING = f"""
SELECT camera, datetime, file_path, 1::BIGINT AS n, count(*) OVER () AS inserted FROM ({_SQL_LASCO})
"""


_STATUS_TIMES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
_STATUS_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages")


def status_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {name: table(spark, sf_dir, name) for name in _STATUS_TABLES}
    return table_status({**frames, "not_there": None}, _STATUS_TIMES)


SQL_STATUS = " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, true AS is_present, count(*) AS n_rows, "
    + (f"min({t})::TIMESTAMP AS first_time, max({t})::TIMESTAMP AS last_time" if (t := _STATUS_TIMES.get(n)) else
       "NULL::TIMESTAMP AS first_time, NULL::TIMESTAMP AS last_time")
    + f" FROM {n}"
    for n in _STATUS_TABLES
) + " UNION ALL SELECT 'not_there', false, 0::BIGINT, NULL::TIMESTAMP, NULL::TIMESTAMP"


def declared_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared tables but one made, one of them filled."""
    root = scratch_path(spark, "status")
    ensure_tables(spark, root, [s for s in TABLES.values() if s.name != "secchi"])
    append_rows(_lasco_rows(spark, sf_dir), TABLES["lasco"], root)
    ensure_tables(spark, root, [TABLES["lasco"]])  # present already: left alone
    return stored_status(spark, root)


SQL_DECLARED = f"""
WITH names(table_name) AS (VALUES {', '.join(f"('{n}')" for n in TABLES)}),
lasco AS (
  SELECT 'lasco' AS table_name, count(*) AS n, TIMESTAMP '2020-01-01' + to_minutes(min(doc_id)::INTEGER) AS lo,
    TIMESTAMP '2020-01-01' + to_minutes(max(doc_id)::INTEGER) AS hi FROM documents
)
SELECT table_name, table_name <> 'secchi' AS is_present, coalesce(n, 0)::BIGINT AS n_rows, lo AS first_time, hi AS last_time
FROM names LEFT JOIN lasco USING (table_name)
"""

QUERIES = {
    "replaced_years": replaced_years,
    "appended_rows": appended_rows,
    "duplicate_keys_refused": duplicate_keys_refused,
    "insert_ignore_batch": insert_ignore_batch,
    "insert_ignore_unique": insert_ignore_unique,
    "insert_ignore_hot": insert_ignore_hot,
    "insert_ignore_chain": insert_ignore_chain,
    "csv_export": csv_export,
    "csv_tables": csv_tables,
    "parquet_export": parquet_export,
    "event_csv": event_csv,
    "index_csv": index_csv,
    "manifest_roundtrip": manifest_roundtrip,
    "orphans": orphans,
    "orphans_deleted": orphans_deleted,
    "table_versions": table_versions,
    "racing_inserts": racing_inserts,
    "table_status": status_report,
    "declared_status": declared_status,
}
ORACLES = {
    "replaced_years": SQL_REPLACED,
    "appended_rows": SQL_APPENDED,
    "duplicate_keys_refused": SQL_DUPLICATES,
    "insert_ignore_batch": SQL_INSERT_IGNORE,
    "insert_ignore_unique": SQL_UNIQUE,
    "insert_ignore_hot": SQL_HOT,
    "insert_ignore_chain": SQL_CHAIN,
    "csv_export": SQL_CSV,
    "csv_tables": _sql_csv_tables(),
    "parquet_export": SQL_PARQUET,
    "event_csv": SQL_EVENT_CSV,
    "index_csv": SQL_INDEX_CSV,
    "manifest_roundtrip": SQL_MANIFEST,
    "orphans": SQL_ORPHANS,
    "orphans_deleted": SQL_ORPHANS_DELETED,
    "table_versions": SQL_VERSIONS,
    "racing_inserts": SQL_RACING,
    "table_status": SQL_STATUS,
    "declared_status": SQL_DECLARED,
}
