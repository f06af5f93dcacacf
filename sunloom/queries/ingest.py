"""Text, JSON and header records: written from the test tables, read back by the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.names import channel_wavelength, goes_path, split_instrument
from sunloom.functions.stages import computed_once
from sunloom.functions.times import (
    base_name,
    date_in_file_name,
    day_of_year_timestamp,
    fractional_hour,
    fractional_hour_timestamp,
    parse_datetime,
    parse_record_time,
    tai_to_utc,
    time_in_file_name,
    utc_to_tai,
)
from sunloom.operators.quality import outcome_counts
from sunloom.plans import images
from sunloom.plans.ingest import ingest_index_years, ingest_solar_wind
from sunloom.queries.inputs import shares, spread, table
from sunloom.session import materialise, scratch_path
from sunloom.sinks.tables import quarantine
from sunloom.sources.fixed_width import parse_fixed_width, read_lines
from sunloom.sources.headers import cut_units, header_units
from sunloom.sources.hpo import HP30, merge_index_documents, parse_index_text, read_index_json
from sunloom.sources.layouts import FIVE_MINUTE, HOURLY, MINUTE, Field, RecordLayout
from sunloom.tables import TABLES, read_table

# --- fixed-width records -------------------------------------------------------

SEED = "(o_orderkey * 31 + o_custkey * 7)"
CLOCK = {
    "Year": "year(o_orderdate)",
    "Decimal_Day": "dayofyear(o_orderdate)",
    "Day": "dayofyear(o_orderdate)",
    "Hour": "o_orderkey % 24",
    "Minute": "o_custkey % 60",
}
CUT_AFTER = 20  # every 53rd line ends behind this field
SPOILT = 10  # every 97th line has this field overprinted


def _top(f: Field) -> int:
    """All nines of the field as an integer."""
    return int("9" * (f.width - 1 if f.decimals is None else f.width - 2))


def _digits(f: Field, i: int) -> str:
    """Whole number printed in the field, fill included; same text in Spark and SQL."""
    if f.name in CLOCK:
        return CLOCK[f.name]
    value = f"({SEED} * {i + 1} + {i}) % {_top(f)}"
    sign = f"CASE WHEN {SEED} % 3 = 1 THEN -1 ELSE 1 END" if f.decimals is not None else "1"
    return f"CASE WHEN ({SEED} + {i}) % 10 = 0 THEN {_top(f)} ELSE ({value}) * ({sign}) END"


def _printed(f: Field, i: int) -> Column:
    whole, size = F.col(f.name), F.abs(F.col(f.name))
    if f.decimals is None:
        text = whole.cast("string")
    else:
        scale = 10**f.decimals
        head = F.when(whole < 0, "-").otherwise("")
        tail = F.lpad((size % scale).cast("string"), f.decimals, "0") if f.decimals else F.lit("")
        text = F.concat(head, F.floor(size / scale).cast("bigint").cast("string"), F.lit("."), tail)
    if i == SPOILT:
        text = F.when(F.expr(f"{SEED} % 97 = 0"), "*" * f.width).otherwise(text)
    return F.lpad(text, f.width, " ").alias(f.name)


def record_lines(spark: SparkSession, sf_dir: str, layout: RecordLayout) -> DataFrame:
    # In order of key, so the first line of a time is that of the lowest key.
    orders = table(spark, sf_dir, "orders")
    orders = orders.repartitionByRange(shares(orders), "o_orderkey").sortWithinPartitions("o_orderkey")
    digits = [
        F.expr(_digits(f, i).replace(SEED, "seed")).cast("bigint").alias(f.name) for i, f in enumerate(layout.fields)
    ]
    seeded = computed_once(orders, {"seed": F.expr(SEED)})
    texts = seeded.select("o_orderkey", "o_custkey", *digits).select(
        F.expr(f"{SEED} % 53 = 0").alias("cut"), *[_printed(f, i) for i, f in enumerate(layout.fields)]
    )
    line = texts.select("cut", F.concat(*[f.name for f in layout.fields]).alias("line"))
    end = layout.fields[CUT_AFTER].start + layout.fields[CUT_AFTER].width
    line = line.select(F.when(F.col("cut"), F.substring("line", 1, end)).otherwise(F.col("line")).alias("line"))
    # A blank line behind every record is dropped by the reader.
    return line.select(F.explode(F.array("line", F.lit(""))).alias("value"))


def _written_lines(spark: SparkSession, sf_dir: str, layout: RecordLayout) -> str:
    path = scratch_path(spark, layout.table)
    record_lines(spark, sf_dir, layout).write.text(path)
    return path


def sql_value(f: Field, i: int) -> str:
    whole = f"({_digits(f, i)})"
    missing = []
    if f.fill is not None:
        missing.append(f"abs({whole}) = {_top(f)}")
    if i == SPOILT:
        missing.append(f"{SEED} % 97 = 0")
    if i > CUT_AFTER:
        missing.append(f"{SEED} % 53 = 0")
    value = f"{whole} / {float(10 ** (f.decimals or 0))}::DOUBLE"
    return f"CASE WHEN {' OR '.join(missing)} THEN NULL ELSE {value} END" if missing else value


def _sql_clock(layout: RecordLayout) -> str:
    minute = f"({CLOCK['Minute']})::INTEGER" if any(f.name == "Minute" for f in layout.fields) else "0"
    return (
        "make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) + to_days((dayofyear(o_orderdate) - 1)::INTEGER)"
        f" + to_hours((o_orderkey % 24)::INTEGER) + to_minutes({minute})"
    )


def sql_records(layout: RecordLayout) -> str:
    columns = ", ".join(f"{sql_value(f, i)} AS {f.name}" for i, f in enumerate(layout.fields))
    return f"SELECT {_sql_clock(layout)} AS datetime, {columns} FROM orders"


def fixed_width_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_fixed_width(read_lines(spark, _written_lines(spark, sf_dir, HOURLY)), HOURLY)


def fixed_width_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_fixed_width(read_lines(spark, _written_lines(spark, sf_dir, FIVE_MINUTE)), FIVE_MINUTE)


def solar_wind_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute records ingested twice: each year replaces itself. As stored, numbers widened."""
    root, path = scratch_path(spark, "omni"), _written_lines(spark, sf_dir, MINUTE)
    for _ in range(2):
        ingest_solar_wind(spark, path, MINUTE, root)
    stored = read_table(spark, root, TABLES[MINUTE.table])
    return stored.select("datetime", *[F.col(f.name.lower()).cast("double").alias(f.name.lower()) for f in MINUTE.fields])


def _sql_stored() -> str:
    columns = ", ".join(
        f"({sql_value(f, i)}){'' if f.decimals is None else '::FLOAT'}::DOUBLE AS {f.name.lower()}"
        for i, f in enumerate(MINUTE.fields)
    )
    rows = f"SELECT o_orderkey, {_sql_clock(MINUTE)} AS datetime, {columns} FROM orders"
    return f"""SELECT * EXCLUDE (o_orderkey) FROM ({rows}) WHERE datetime IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY datetime ORDER BY o_orderkey) = 1"""


# --- blank-separated text and JSON ---------------------------------------------


def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = spread(table(spark, sf_dir, "orders"))
    line = F.expr(
        """format_string('%04d %02d %02d %04.1f %05.2f %11.5f %11.5f %s %4d %d',
             year(o_orderdate), month(o_orderdate), day(o_orderdate),
             (o_orderkey % 48) / 2.0D, (o_orderkey % 48) / 2.0D + 0.25D, 0.0D, 0.0D,
             CASE WHEN o_orderkey % 11 = 0 THEN '-1.000' ELSE format_string('%6.3f', (o_custkey % 90) / 10.0D) END,
             CASE WHEN o_orderkey % 13 = 0 THEN -1 ELSE o_custkey % 400 END, 1)"""
    )
    noted = F.when(F.expr("o_orderkey % 7 = 0"), F.concat(line, F.lit(" # provisional 9 9"))).otherwise(line)
    return orders.select(F.explode(F.array(F.lit("# Year Month Day"), noted, F.lit("  "))).alias("value"))


def blank_separated_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index-text")
    index_lines(spark, sf_dir).write.text(path)
    return parse_index_text(read_lines(spark, path), HP30)


SQL_BLANK = """
SELECT date_trunc('day', o_orderdate)::TIMESTAMP + to_minutes((o_orderkey % 48 * 30)::INTEGER) AS datetime,
  year(o_orderdate)::DOUBLE AS year, month(o_orderdate)::DOUBLE AS month, day(o_orderdate)::DOUBLE AS day,
  (o_orderkey % 48) / 2.0::DOUBLE AS hh_start,
  CASE WHEN o_orderkey % 11 <> 0 THEN (o_custkey % 90) / 10.0::DOUBLE END AS Hp30,
  CASE WHEN o_orderkey % 13 <> 0 THEN (o_custkey % 400)::DOUBLE END AS ap30
FROM orders
"""


def index_documents(spark: SparkSession, sf_dir: str, name: str, delay: int, empty: int) -> DataFrame:
    """One document of four half hours per order, two hours apart; every fifth is empty."""
    orders = spread(table(spark, sf_dir, "orders"))
    first = f"TIMESTAMP_NTZ'2000-01-01 00:00:00' + make_dt_interval(0, CAST(o_orderkey * 2 AS INT), {delay})"
    steps = f"IF(o_orderkey % 5 = {empty}, CAST(array() AS array<int>), sequence(0, 3))"
    return orders.selectExpr(
        f"""transform({steps}, i -> date_format({first} + make_dt_interval(0, 0, i * 30),
              "yyyy-MM-dd'T'HH:mm:ss'Z'")) AS datetime""",
        f"""transform({steps}, i -> CASE WHEN (o_custkey + i) % 10 = 0 THEN -1.0D
              ELSE (o_custkey + i) % 90 / 3.0D END) AS {name}""",
    )


def _written_documents(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    hp, ap = scratch_path(spark, "hp"), scratch_path(spark, "ap")
    index_documents(spark, sf_dir, HP30.hp, 0, 1).write.json(hp)
    index_documents(spark, sf_dir, HP30.ap, 30, 0).write.json(ap)
    return hp, ap


def json_parallel_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    hp, ap = _written_documents(spark, sf_dir)
    merged = merge_index_documents(
        read_index_json(spark, hp, HP30.hp, False), read_index_json(spark, ap, HP30.ap, False), HP30
    )
    return merged


def _sql_documents(name: str, delay: int, skipped: int) -> str:
    return f"""
SELECT TIMESTAMP '2000-01-01' + to_minutes((o_orderkey * 120 + {delay} + i * 30)::INTEGER) AS datetime,
  CASE WHEN (o_custkey + i) % 10 <> 0 THEN (o_custkey + i) % 90 / 3.0::DOUBLE END AS {name}
FROM orders, range(4) AS r(i) WHERE o_orderkey % 5 <> {skipped}
"""


SQL_JSON = f"""
WITH hp AS ({_sql_documents('Hp30', 0, 1)}), ap AS ({_sql_documents('ap30', 30, 0)})
SELECT datetime, year(datetime)::INTEGER AS year, month(datetime)::INTEGER AS month, day(datetime)::INTEGER AS day,
  hour(datetime) + minute(datetime) / 60.0::DOUBLE AS hh_start, Hp30, ap30
FROM hp FULL JOIN ap USING (datetime)
"""


def index_years_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged documents ingested twice, counted per stored year."""
    hp, ap = _written_documents(spark, sf_dir)
    root = scratch_path(spark, "hpo")
    for _ in range(2):
        ingest_index_years(spark, hp, ap, HP30, root, one_per_file=False)
    stored = read_table(spark, root, TABLES[HP30.table])
    return stored.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count("*").alias("n"), F.count("hp30").alias("n_hp"), F.count("ap30").alias("n_ap"),
        F.sum(F.col("ap30").cast("bigint")).alias("sum_ap"),
    )


SQL_INDEX_STORED = f"""
WITH hp AS ({_sql_documents('Hp30', 0, 1)}), ap AS ({_sql_documents('ap30', 30, 0)})
SELECT year(datetime)::INTEGER AS year, count(*) AS n, count(Hp30) AS n_hp, count(ap30) AS n_ap,
  sum(round_even(ap30, 0))::BIGINT AS sum_ap
FROM hp FULL JOIN ap USING (datetime) GROUP BY 1
"""

# --- timestamps ----------------------------------------------------------------


def doy_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    year, month = F.year("o_orderdate"), F.month("o_orderdate")
    minute = F.when(F.expr("o_orderkey % 17 <> 0"), F.expr("o_custkey % 60").cast("double"))
    hour = F.expr("CASE WHEN o_orderkey % 19 = 0 THEN 23.999D ELSE (o_orderkey % 480) / 20.0D END")
    by_day = day_of_year_timestamp(year.cast("double"), F.dayofyear("o_orderdate"), F.expr("o_orderkey % 24"), minute)
    by_hour = fractional_hour_timestamp(year, month, F.expr("o_custkey % 33"), hour)
    return o.select("o_orderkey", by_day.alias("by_day"), by_hour.alias("by_hour"), fractional_hour(by_day).alias("hh"))


SQL_DOY = """
WITH t AS (
  SELECT o_orderkey, o_custkey, o_orderdate,
    CASE WHEN o_orderkey % 17 <> 0 THEN make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0)
      + to_days((dayofyear(o_orderdate) - 1)::INTEGER) + to_hours((o_orderkey % 24)::INTEGER)
      + to_minutes((o_custkey % 60)::INTEGER) END AS by_day,
    (o_orderkey % 480) // 20 AS h, (o_orderkey % 20) * 3 AS m
  FROM orders
)
SELECT o_orderkey, by_day,
  CASE WHEN o_orderkey % 19 <> 0 THEN try(make_timestamp(year(o_orderdate), month(o_orderdate), o_custkey % 33, h, m, 0)) END
    AS by_hour,
  hour(by_day) + minute(by_day) / 60.0::DOUBLE AS hh
FROM t
"""

# How a time is written, and what is left of it: us, ms, s or day.
FORMATS = (
    ("yyyy.MM.dd_HH:mm:ss'_TAI'", "s"),
    ("yyyy.MM.dd_HH:mm:ss.SSS'_TAI'", "ms"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "us"),
    ("yyyy-MM-dd'T'HH:mm:ss", "s"),
    ("yyyy/MM/dd'T'HH:mm:ss.SSS", "ms"),
    ("yyyy-MM-dd HH:mm:ss.SSS", "ms"),
    ("yyyy/MM/dd HH:mm:ss", "s"),
    ("dd/MM/yy HH:mm:ss", "s"),
    ("dd/MM/yyyy HH:mm:ss.SSS", "ms"),
    ("yyyy-MM-dd", "day"),
    ("dd/MM/yy", "day"),
    ("dd/MM/yyyy", "day"),
    ("yyyy-M-d H:m:s", "s"),
    ("'  'yyyy/M/d H:m:s.SSS' '", "ms"),
    ("yyyy-MM-dd HH.mm", None),
    ("dd-MM-yyyy", None),
)
_MOMENT = "o_orderdate + make_dt_interval(0, 0, 0, CAST((o_orderkey * 7919 % 86400000000) / 1000000 AS DECIMAL(18,6)))"


def multi_format_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(table(spark, sf_dir, "orders")).withColumn("ts", F.expr(_MOMENT))
    form = F.expr(f"o_orderkey % {len(FORMATS)}")
    text = F.lit(None).cast("string")
    for i, (pattern, _) in enumerate(FORMATS):
        text = F.when(form == i, F.date_format("ts", pattern)).otherwise(text)
    written = o.withColumn("text", text)
    return written.select(
        "o_orderkey", parse_datetime(F.col("text")).alias("parsed"), parse_record_time(F.col("text")).alias("record_time")
    )


_SQL_MOMENT = "o_orderdate + to_microseconds(o_orderkey * 7919 % 86400000000)"
_SQL_KEPT = " ".join(
    f"WHEN {i} THEN {'NULL' if kept is None else 'ts' if kept == 'us' else f'''date_trunc('{dict(ms='millisecond', s='second', day='day')[kept]}', ts)::TIMESTAMP'''}"
    for i, (_, kept) in enumerate(FORMATS)
)
SQL_FORMATS = f"""
WITH t AS (SELECT o_orderkey, o_orderkey % {len(FORMATS)} AS form, {_SQL_MOMENT} AS ts FROM orders),
p AS (SELECT o_orderkey, form, CASE form {_SQL_KEPT} END AS parsed FROM t)
SELECT o_orderkey, parsed, CASE WHEN form < 4 THEN parsed END AS record_time FROM p
"""


def file_name_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("ts", F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"))
    name = F.expr(
        """CASE o_orderkey % 5
             WHEN 0 THEN concat('aia.lev1_euv_12s.', date_format(ts, "yyyy-MM-dd'T'HHmmss'Z'"), '.193.image_lev1.fits')
             WHEN 1 THEN concat('hmi.m_45s.', date_format(ts, "yyyyMMdd_HHmmss'_TAI'"), '.2.magnetogram.fits')
             WHEN 2 THEN concat('sci_xrsf-l2-avg1m_g16_d', date_format(ts, 'yyyyMMdd'), '_v2-2-0.nc')
             WHEN 3 THEN concat('sci_g16_d', year(ts), '1399_v1.nc')
             ELSE concat('2200', o_orderkey, '.fts') END"""
    )
    named = o.withColumn("path", F.concat(F.lit("/archive/x/"), name))
    base = base_name(F.col("path"))
    return named.select(
        "o_orderkey",
        time_in_file_name(F.col("path")).alias("obs_time"),
        date_in_file_name(base).cast("string").alias("file_date"),
        base.alias("name"),
        goes_path(F.lit("/archive"), F.lit(16), base).alias("stored_at"),
    )


SQL_FILE_NAMES = """
WITH t AS (SELECT o_orderkey, o_orderkey % 5 AS kind, o_orderdate + to_seconds((o_orderkey % 86400)::INTEGER) AS ts FROM orders),
n AS (
  SELECT *, CASE kind WHEN 0 THEN strftime(ts, 'aia.lev1_euv_12s.%Y-%m-%dT%H%M%SZ.193.image_lev1.fits')
    WHEN 1 THEN strftime(ts, 'hmi.m_45s.%Y%m%d_%H%M%S_TAI.2.magnetogram.fits')
    WHEN 2 THEN strftime(ts, 'sci_xrsf-l2-avg1m_g16_d%Y%m%d_v2-2-0.nc')
    WHEN 3 THEN strftime(ts, 'sci_g16_d%Y1399_v1.nc') ELSE '2200' || o_orderkey || '.fts' END AS name FROM t
)
SELECT o_orderkey, CASE WHEN kind < 2 THEN ts END AS obs_time,
  CASE WHEN kind = 2 THEN strftime(ts, '%Y-%m-%d') END AS file_date, name,
  '/archive/g16/' || CASE WHEN kind = 2 THEN strftime(ts, '%Y') ELSE '0000' END || '/' || name AS stored_at
FROM n
"""


def tai_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    named = e.withColumn(
        "instrument",
        F.expr(
            """CASE event_type WHEN 'click' THEN 'aia_193' WHEN 'view' THEN 'hmi_magnetogram'
                 WHEN 'purchase' THEN 'hmi_ic_45s' WHEN 'error' THEN 'aia_x' ELSE 'lasco' END"""
        ),
    ).withColumn("parts", split_instrument(F.col("instrument")))
    telescope, channel = F.col("parts.telescope"), F.col("parts.channel")
    return named.select(
        "event_id",
        telescope.alias("telescope"),
        channel.alias("channel"),
        channel_wavelength(telescope, channel).cast("double").alias("wavelength"),
        tai_to_utc(F.col("ts"), telescope).alias("utc"),
        utc_to_tai(F.col("ts"), telescope).alias("tai"),
    )


SQL_TAI = """
WITH t AS (
  SELECT event_id, ts, CASE WHEN event_type IN ('click', 'error') THEN 'aia' WHEN event_type = 'signup' THEN 'lasco'
      ELSE 'hmi' END AS telescope,
    CASE event_type WHEN 'click' THEN '193' WHEN 'view' THEN 'm_45s' WHEN 'purchase' THEN 'ic_45s' WHEN 'error' THEN 'x'
      ELSE '' END AS channel
  FROM events
)
SELECT event_id, telescope, channel, CASE WHEN channel = '193' THEN 193.0::DOUBLE END AS wavelength,
  CASE WHEN telescope = 'hmi' THEN ts - INTERVAL 37 SECOND ELSE ts END AS utc,
  CASE WHEN telescope = 'hmi' THEN ts + INTERVAL 37 SECOND ELSE ts END AS tai
FROM t
"""

# --- image headers -------------------------------------------------------------


# Filled in one piece: padding by single blanks copies them one at a time.
BLANKS = " " * 80


def _card(key: str, value: Column) -> Column:
    return F.rpad(F.concat(F.lit(f"{key:<8}= "), value), 80, BLANKS)


def _words(text: Column) -> Column:
    return F.concat(F.lit("'"), F.format_string("%-8s", F.replace(text, F.lit("'"), F.lit("''"))), F.lit("' / as recorded"))


def _unit(*cards: Column) -> Column:
    return F.rpad(F.concat_ws("", *cards, F.rpad(F.lit("END"), 80, BLANKS)), 2880, BLANKS)


def _only(condition: str, card: Column) -> Column:
    """The card where the condition holds; a skipped card leaves no gap."""
    return F.when(F.expr(condition), card)


def sdo_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sdo_contents(spread(table(spark, sf_dir, "events")))


def sdo_contents(e: DataFrame) -> DataFrame:
    """One image file per event: an empty first unit and a second one, or all in the first."""
    t_rec = F.expr(
        """CASE WHEN event_id % 11 = 2 THEN 'unknown'
                WHEN event_type IN ('click', 'view') THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
                ELSE date_format(ts, "yyyy.MM.dd_HH:mm:00'_TAI'") END"""
    )
    cards = [
        _card("T_REC", _words(t_rec)),
        _only("event_id % 11 <> 1", _card("QUALITY", F.expr("lpad(user_id % 4, 20)"))),
        _card("TELESCOP", _words(F.expr("CASE WHEN event_type IN ('click', 'view') THEN 'SDO/AIA' ELSE 'SDO/HMI' END"))),
        _only("event_type = 'click'", _card("WAVELNTH", F.lpad(F.lit("193"), 20, " "))),
        _only("event_type = 'view'", _card("WAVELNTH", F.lpad(F.lit("0"), 20, " "))),
        _only("event_type = 'error'", _card("CONTENT", _words(F.lit("CONTINUUM INTENSITY")))),
        _only("event_type = 'signup'", _card("CONTENT", _words(F.lit("Doppler's Map")))),
    ]
    simple = [_card("SIMPLE", F.lpad(F.lit("T"), 20, " ")), _card("BITPIX", F.lpad(F.lit("8"), 20, " "))]
    naxis = _card("NAXIS", F.lpad(F.lit("0"), 20, " "))
    table_unit = _card("XTENSION", _words(F.lit("BINTABLE")))
    content = (
        F.when(F.expr("event_id % 11 = 0"), F.lit("not an image"))
        .when(F.expr("event_id % 11 = 3"), _unit(*simple, naxis, *cards))
        .otherwise(F.concat(_unit(*simple, naxis), _unit(table_unit, *cards)))
    )
    return e.select(
        F.format_string("/in/%09d.fits", "event_id").alias("path"),
        content.cast("binary").alias("content"),
        F.expr("event_id % 11 <> 4").alias("has_pixels"),
    )


def classify_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    found = images.classify_sdo(units, has_data="has_pixels").drop("has_pixels")
    return found.withColumns({c: F.col(c).cast("double") for c in ("quality", "wavelength")})


def _sql_classified(check_quality: bool, check_data: bool) -> str:
    return f"""
classified AS (
  SELECT event_id, printf('/in/%09d.fits', event_id) AS path,
    CASE WHEN event_id % 11 = 0 THEN 'invalid_file' WHEN event_id % 11 IN (1, 2) THEN 'invalid_header'
      {"WHEN event_id % 11 = 4 THEN 'invalid_data'" if check_data else ""}
      {"WHEN user_id % 4 <> 0 THEN 'non_zero_quality'" if check_quality else ""} END AS error,
    CASE WHEN event_type IN ('click', 'view') THEN 'aia' ELSE 'hmi' END AS telescope,
    CASE event_type WHEN 'click' THEN '193' WHEN 'view' THEN NULL WHEN 'error' THEN 'ic_45s'
      WHEN 'signup' THEN 'doppler''s_map' ELSE 'm_45s' END AS channel,
    date_trunc(CASE WHEN event_type IN ('click', 'view') THEN 'millisecond' ELSE 'minute' END, ts)::TIMESTAMP AS datetime,
    (user_id % 4)::DOUBLE AS quality, CASE WHEN event_type = 'click' THEN 193.0::DOUBLE END AS wavelength,
    CASE event_type WHEN 'error' THEN 'CONTINUUM INTENSITY' WHEN 'signup' THEN 'Doppler''s Map' END AS content
  FROM events
)
"""


SQL_CLASSIFY = f"""
WITH {_sql_classified(True, True)}
SELECT path, error, {', '.join(f'CASE WHEN error IS NULL THEN {c} END AS {c}'
    for c in ('telescope', 'channel', 'datetime', 'quality', 'wavelength', 'content'))} FROM classified
"""


def header_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    found = images.classify_sdo(units, has_data="has_pixels")
    return outcome_counts(found.select(F.coalesce("error", F.lit("valid")).alias("outcome")), "outcome")


SQL_OUTCOMES = f"""
WITH {_sql_classified(True, True)}
SELECT coalesce(error, 'valid') AS outcome, count(*) AS n FROM classified GROUP BY 1
"""


def sdo_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers to the stored catalogue, twice; the second run adds nothing."""
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    found = materialise(images.classify_sdo(units, check_quality=False), "classified")
    root, refused = scratch_path(spark, "sdo"), scratch_path(spark, "refused")
    for _ in range(2):
        images.register_sdo(found, root, refused, archive="/archive")
    stored = read_table(spark, root, TABLES["sdo"]).drop("datetime_year", "exposure_time")
    return stored.withColumns({c: F.col(c).cast("double") for c in ("quality", "wavelength")})


SQL_SDO_REGISTERED = f"""
WITH {_sql_classified(False, False)},
utc AS (
  SELECT *, CASE WHEN telescope = 'hmi' THEN datetime - INTERVAL 37 SECOND ELSE datetime END AS t
  FROM classified WHERE error IS NULL AND channel IS NOT NULL
)
SELECT telescope, channel, t AS datetime,
  '/archive/' || telescope || strftime(t, '/%Y/%Y%m%d/') || printf('%09d.fits', event_id) AS file_path, quality, wavelength
FROM utc QUALIFY row_number() OVER (PARTITION BY telescope, channel, t ORDER BY event_id) = 1
"""


def refused_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two runs of the registration set aside, each file once: refused headers, and
    valid ones that lack a part of the key."""
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    found = materialise(images.classify_sdo(units, check_quality=False), "classified")
    root, refused = scratch_path(spark, "sdo"), scratch_path(spark, "refused")
    for _ in range(2):
        images.register_sdo(found, root, refused, archive="/archive")
    return spark.read.parquet(refused).select("path", "error")


SQL_REFUSED = f"""
WITH {_sql_classified(False, False)}
SELECT path, coalesce(error, 'missing_key') AS error FROM classified WHERE error IS NOT NULL OR channel IS NULL
"""


def quarantine_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch set aside twice is there once."""
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    out = scratch_path(spark, "quarantine")
    found = materialise(images.classify_sdo(units, has_data="has_pixels").select("path", "error"), "classified")
    for _ in range(2):
        quarantine(found, out)
    return outcome_counts(spark.read.parquet(out), "error")


def filing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each valid image goes; every fifth place is taken by another file already."""
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    found = materialise(images.classify_sdo(units, check_quality=False), "classified")
    records = images.sdo_records(found, "/archive")
    held = records.where("CAST(substring(path, 5, 9) AS INT) % 5 = 0").select(F.col("file_path").alias("path"))
    fresh, skipped = images.split_held(records, held)
    fates = fresh.withColumn("outcome", F.lit("valid")).unionByName(skipped.withColumn("outcome", F.lit("skipped")))
    return fates.select("path", "file_path", "outcome")


SQL_FILING = f"""
WITH {_sql_classified(False, False)},
utc AS (
  SELECT *, CASE WHEN telescope = 'hmi' THEN datetime - INTERVAL 37 SECOND ELSE datetime END AS t
  FROM classified WHERE error IS NULL
)
SELECT path, '/archive/' || telescope || strftime(t, '/%Y/%Y%m%d/') || printf('%09d.fits', event_id) AS file_path,
  CASE WHEN event_id % 5 = 0 THEN 'skipped' ELSE 'valid' END AS outcome FROM utc
"""


def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refused headers per class folder, as read back."""
    units = header_units(cut_units(sdo_files(spark, sf_dir)))
    out = scratch_path(spark, "quarantine")
    found = images.classify_sdo(units, has_data="has_pixels").select("path", "error")
    quarantine(materialise(found, "classified"), out)
    return outcome_counts(spark.read.parquet(out), "error")


SQL_QUARANTINE = f"""
WITH {_sql_classified(True, True)}
SELECT error, count(*) AS n FROM classified WHERE error IS NOT NULL GROUP BY 1
"""


def camera_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera_contents(spread(table(spark, sf_dir, "orders")))


def camera_contents(o: DataFrame) -> DataFrame:
    """Coronagraph or EUV files from orders: date and time apart or together, some without."""
    o = o.withColumn("ts", F.expr("o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400)"))
    day = F.expr("CASE WHEN o_orderkey % 3 = 0 THEN date_format(ts, 'dd/MM/yy') ELSE date_format(ts, 'yyyy/MM/dd') END")
    cards = [
        _card("SIMPLE", F.lpad(F.lit("T"), 20, " ")),
        _only("o_orderkey % 7 < 5", _card("DATE-OBS", _words(day))),
        _only("o_orderkey % 7 < 4", _card("TIME-OBS", _words(F.date_format("ts", "HH:mm:ss.SSS")))),
        _only("o_orderkey % 7 = 5", _card("T_OBS", _words(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")))),
        _card("DETECTOR", _words(F.expr("CASE o_custkey % 3 WHEN 0 THEN 'EUVI' WHEN 1 THEN 'C2' ELSE 'COR1' END"))),
        _card("EXPTIME", F.expr("lpad(cast((o_custkey % 4) * 2.5D AS string), 20)")),
        _only("o_custkey % 5 = 0", _card("EXP_TIME", F.lpad(F.lit("9.25"), 20, " "))),
        _only("o_custkey % 2 = 0", _card("FILTER", _words(F.lit("Orange")))),
        _card("FILTER1", _words(F.lit("S1"))),
        _card("WAVELNTH", F.expr("lpad(CASE WHEN o_orderkey % 2 = 0 THEN 195 ELSE 0 END, 20)")),
    ]
    return o.select(
        F.format_string("/in/%09d.fts", "o_orderkey").alias("path"), _unit(*cards).cast("binary").alias("content")
    )


_SQL_CAMERA = """
files AS (
  SELECT o_orderkey, printf('/in/%09d.fts', o_orderkey) AS path, o_orderkey % 7 AS form,
    o_orderdate + to_seconds((o_orderkey % 86400)::INTEGER) AS ts,
    CASE o_custkey % 3 WHEN 0 THEN 'euvi' WHEN 1 THEN 'c2' ELSE 'cor1' END AS detector,
    CASE WHEN o_custkey % 4 <> 0 THEN (o_custkey % 4) * 2.5::DOUBLE WHEN o_custkey % 5 = 0 THEN 9.25::DOUBLE END AS exposure_time,
    CASE WHEN o_custkey % 2 = 0 THEN 'Orange' ELSE 'S1' END AS filter,
    CASE WHEN o_orderkey % 2 = 0 THEN 195 END AS wavelength
  FROM orders
),
rec AS (
  SELECT *, CASE WHEN form IN (0, 1, 2, 3, 5) THEN ts WHEN form = 4 THEN date_trunc('day', ts)::TIMESTAMP END AS datetime
  FROM files
)
"""


def lasco_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.lasco_records(header_units(cut_units(camera_files(spark, sf_dir))))


SQL_LASCO = f"""
WITH {_SQL_CAMERA}
SELECT path, CASE WHEN datetime IS NULL THEN 'invalid_time' END AS error, detector AS camera, datetime,
  path AS file_path, exposure_time, filter FROM rec
"""


def secchi_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = header_units(cut_units(camera_files(spark, sf_dir)))
    found = images.secchi_records(units, F.lit("science"), F.lit("ahead"))
    return found.withColumn("wavelength", F.col("wavelength").cast("double"))


SQL_SECCHI = f"""
WITH {_SQL_CAMERA}
SELECT path, CASE WHEN datetime IS NULL THEN 'invalid_time' END AS error, 'science' AS datatype, 'ahead' AS spacecraft,
  detector AS instrument, CASE WHEN detector = 'euvi' THEN wavelength::VARCHAR END AS channel, datetime,
  path AS file_path, exposure_time, filter, wavelength::DOUBLE AS wavelength FROM rec
"""


def secchi_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-wide times collide on purpose: the first file of a key stays, missing channels equal."""
    units = header_units(cut_units(camera_files(spark, sf_dir)))
    records = images.secchi_records(units, F.lit("science"), F.lit("ahead"))
    coarse = materialise(records.withColumn("datetime", F.date_trunc("month", "datetime").cast("timestamp_ntz")), "secchi")
    root, refused = scratch_path(spark, "secchi"), scratch_path(spark, "refused")
    images.register_secchi(coarse, root, refused)
    stored = read_table(spark, root, TABLES["secchi"])
    return stored.select("instrument", "channel", "datetime", "file_path", "filter")


SQL_SECCHI_REGISTERED = f"""
WITH {_SQL_CAMERA},
coarse AS (
  SELECT detector AS instrument, CASE WHEN detector = 'euvi' THEN wavelength::VARCHAR END AS channel,
    date_trunc('month', datetime)::TIMESTAMP AS datetime, path AS file_path, filter
  FROM rec WHERE datetime IS NOT NULL
)
SELECT * FROM coarse QUALIFY row_number() OVER (PARTITION BY instrument, channel, datetime ORDER BY file_path) = 1
"""

QUERIES = {
    "fixed_width_hourly": fixed_width_hourly,
    "fixed_width_5min": fixed_width_5min,
    "solar_wind_stored": solar_wind_stored,
    "blank_separated_ingest": blank_separated_ingest,
    "json_parallel_arrays": json_parallel_arrays,
    "index_years_stored": index_years_stored,
    "doy_timestamp": doy_timestamp,
    "multi_format_datetime": multi_format_datetime,
    "file_name_times": file_name_times,
    "tai_shift": tai_shift,
    "classify_headers": classify_headers,
    "header_outcomes": header_outcomes,
    "sdo_registered": sdo_registered,
    "refused_keys": refused_keys,
    "quarantine_replayed": quarantine_replayed,
    "filing_outcomes": filing_outcomes,
    "quarantine_counts": quarantine_counts,
    "lasco_records": lasco_records,
    "secchi_records": secchi_records,
    "secchi_registered": secchi_registered,
}
ORACLES = {
    "fixed_width_hourly": sql_records(HOURLY),
    "fixed_width_5min": sql_records(FIVE_MINUTE),
    "solar_wind_stored": _sql_stored(),
    "blank_separated_ingest": SQL_BLANK,
    "json_parallel_arrays": SQL_JSON,
    "index_years_stored": SQL_INDEX_STORED,
    "doy_timestamp": SQL_DOY,
    "multi_format_datetime": SQL_FORMATS,
    "file_name_times": SQL_FILE_NAMES,
    "tai_shift": SQL_TAI,
    "classify_headers": SQL_CLASSIFY,
    "header_outcomes": SQL_OUTCOMES,
    "sdo_registered": SQL_SDO_REGISTERED,
    "refused_keys": SQL_REFUSED,
    "quarantine_replayed": SQL_QUARANTINE,
    "filing_outcomes": SQL_FILING,
    "quarantine_counts": SQL_QUARANTINE,
    "lasco_records": SQL_LASCO,
    "secchi_records": SQL_SECCHI,
    "secchi_registered": SQL_SECCHI_REGISTERED,
}
