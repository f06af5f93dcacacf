"""Lookups, file reconciliation, download planning, grids."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.names import (
    is_spike,
    lasco_folder,
    satellite_generation,
    satellite_tag,
    sdo_folder,
    secchi_folder,
)
from sunloom.functions.nested import first_existing
from sunloom.functions.times import base_name
from sunloom.operators.grids import months
from sunloom.operators.reconcile import absent, all_files, distinct_names, present, wanted_files
from sunloom.plans.images import camera_images, spacecraft_images
from sunloom.plans.planning import (
    coronagraph_folders,
    manifest_files,
    satellite_files,
    satellite_folders,
    satellite_plan,
    spacecraft_folders,
    uncovered_targets,
    yearly_urls,
)
from sunloom.queries.analytic import _SQL_TARGETS, hourly
from sunloom.queries.inputs import image_catalog, table
from sunloom.sinks.exports import in_dates
from sunloom.sources.files import first_files, without_spikes

_START, _END = datetime(2024, 1, 10, 6), datetime(2024, 1, 20, 18)


def camera_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lasco = table(spark, sf_dir, "events").selectExpr(
        "concat('c', user_id % 4 + 1) AS camera", "ts AS datetime", "concat('f/', event_id) AS file_path"
    )
    return camera_images(lasco, "c2", _START, _END)


SQL_CAMERA = f"""
SELECT 'c2' AS camera, ts AS datetime, 'f/' || event_id AS file_path FROM events
WHERE user_id % 4 = 1 AND ts BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'
"""


def _secchi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CASE WHEN user_id % 2 = 0 THEN 'science' ELSE 'beacon' END AS datatype",
        "CASE WHEN user_id % 3 = 0 THEN 'ahead' ELSE 'behind' END AS spacecraft",
        "CASE WHEN event_type IN ('click', 'view') THEN 'euvi' ELSE 'cor1' END AS instrument",
        "CASE event_type WHEN 'click' THEN '171' WHEN 'view' THEN '195' END AS channel",
        "ts AS datetime",
        "event_id",
    )


def spacecraft_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the channel given, and without it."""
    secchi = _secchi(spark, sf_dir)
    one = spacecraft_images(secchi, "science", "ahead", "euvi", _START, _END, "171")
    rest = spacecraft_images(secchi, "beacon", "behind", "cor1", _START, _END)
    return one.unionByName(rest).select("event_id", "instrument", "channel", "datetime")


SQL_SPACECRAFT = f"""
SELECT event_id, CASE WHEN event_type = 'click' THEN 'euvi' ELSE 'cor1' END AS instrument,
  CASE WHEN event_type = 'click' THEN '171' END AS channel, ts AS datetime
FROM events WHERE ts BETWEEN TIMESTAMP '{_START}' AND TIMESTAMP '{_END}'
  AND ((user_id % 2 = 0 AND user_id % 3 = 0 AND event_type = 'click')
    OR (user_id % 2 <> 0 AND user_id % 3 <> 0 AND event_type NOT IN ('click', 'view')))
"""


def dated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional bounds: only a start, only an end, both."""
    rows = table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("datetime"))
    first, last = date(2024, 1, 5), date(2024, 1, 10)
    cuts = {"from": in_dates(rows, first), "to": in_dates(rows, end=last), "both": in_dates(rows, first, last)}
    found = [frame.withColumn("bounds", F.lit(name)) for name, frame in cuts.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


_LO, _HI = "ts >= TIMESTAMP '2024-01-05'", "ts <= TIMESTAMP '2024-01-10 23:59:59'"
SQL_DATED = f"""
SELECT event_id, ts AS datetime, 'from' AS bounds FROM events WHERE {_LO}
UNION ALL SELECT event_id, ts, 'to' FROM events WHERE {_HI}
UNION ALL SELECT event_id, ts, 'both' FROM events WHERE {_LO} AND {_HI}
"""


def _page_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote listing: every fifth name is a spike file."""
    name = "concat(CASE WHEN page_id % 5 = 0 THEN 'aia_Spike_' ELSE 'aia_' END, page_id % 1000, '.fits')"
    return table(spark, sf_dir, "pages").selectExpr("page_id", "url", f"{name} AS name")


_SQL_PAGE_FILES = """
files AS (
  SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN 'aia_Spike_' ELSE 'aia_' END || (page_id % 1000) || '.fits' AS name
  FROM pages
)
"""


def _held_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored paths under several class folders."""
    return table(spark, sf_dir, "documents").selectExpr(
        "concat('/archive/', element_at(array('aia', 'downloaded', 'invalid_file'), CAST(doc_id % 3 + 1 AS INT)), '/x/aia_',"
        " doc_id % 2000, '.fits') AS path"
    )


def file_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which listed files are already held under any class folder, by base name."""
    held = _held_paths(spark, sf_dir).select(base_name(F.col("path")).alias("name"))
    files = _page_files(spark, sf_dir)
    return (
        present(files, held, "name").withColumn("is_held", F.lit(True))
        .unionByName(absent(files, held, "name").withColumn("is_held", F.lit(False)))
        .select("page_id", "name", "is_held")
    )


SQL_PRESENCE = f"""
WITH {_SQL_PAGE_FILES}
SELECT page_id, name, name IN (SELECT 'aia_' || (doc_id % 2000) || '.fits' FROM documents) AS is_held FROM files
"""


def download_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files still wanted, spikes left out; and all of them where overwriting."""
    held = _held_paths(spark, sf_dir).select(base_name(F.col("path")).alias("name"))
    files = without_spikes(_page_files(spark, sf_dir))
    fresh = wanted_files(files, held, "name").withColumn("mode", F.lit("missing"))
    every = wanted_files(files, held, "name", overwrite=True).withColumn("mode", F.lit("overwrite"))
    return all_files(fresh, every).select("page_id", "url", "name", "mode")


SQL_PLAN = f"""
WITH {_SQL_PAGE_FILES}, clean AS (SELECT * FROM files WHERE NOT contains(lower(name), 'spike'))
SELECT page_id, url, name, 'missing' AS mode FROM clean
WHERE name NOT IN (SELECT 'aia_' || (doc_id % 2000) || '.fits' FROM documents)
UNION ALL SELECT page_id, url, name, 'overwrite' FROM clean
"""


def name_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_names(_page_files(spark, sf_dir)).withColumn("is_spike", is_spike(F.col("name")))


SQL_NAMES = f"WITH {_SQL_PAGE_FILES} SELECT DISTINCT name, contains(name, 'Spike') AS is_spike FROM files"


def first_listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry look at the first twenty files of the sorted listing."""
    return first_files(_held_paths(spark, sf_dir).withColumn("name", base_name(F.col("path"))), 20)


SQL_FIRST = """
SELECT '/archive/' || (CASE doc_id % 3 WHEN 0 THEN 'aia' WHEN 1 THEN 'downloaded' ELSE 'invalid_file' END) || '/x/aia_'
  || (doc_id % 2000) || '.fits' AS path, 'aia_' || (doc_id % 2000) || '.fits' AS name
FROM documents ORDER BY path LIMIT 20
"""


def _satellite_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the first to the last order of each customer group, as a satellite's mission."""
    orders = table(spark, sf_dir, "orders").selectExpr("CAST(13 + o_custkey % 7 AS INT) AS satellite", "o_orderdate")
    return orders.groupBy("satellite").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


_SQL_SPANS = """
spans AS (
  SELECT (13 + o_custkey % 7)::INTEGER AS satellite, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY 1
),
monthly AS (
  SELECT satellite, first, last, unnest(generate_series(date_trunc('month', first), date_trunc('month', last), INTERVAL 1 MONTH)) AS m
  FROM spans
)
"""


def month_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = months(_satellite_spans(spark, sf_dir), "first", "last")
    return grid.select(
        "satellite", "year", "month", satellite_tag(F.col("satellite")).alias("tag"),
        satellite_generation(F.col("satellite")).alias("generation"),
    )


SQL_MONTHS = f"""
WITH {_SQL_SPANS}
SELECT satellite, year(m)::INTEGER AS year, month(m)::INTEGER AS month, 'g' || satellite AS tag,
  CASE WHEN satellite >= 16 THEN 'r' ELSE 'legacy' END AS generation FROM monthly
"""


def remote_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remote folders of the satellites by month, of the cameras and of the twin spacecraft by day."""
    spans = _satellite_spans(spark, sf_dir)
    goes = satellite_folders(spans, "xrs", "first", "last").select("folder")
    days = spans.groupBy().agg(F.min("first").alias("first"), F.max("last").alias("last"))
    lasco = coronagraph_folders(days, "first", "last", ("c2", "c3")).select("folder")
    secchi = spacecraft_folders(days, "first", "last", categories=("img",), instruments=("cor1", "euvi")).select("folder")
    return goes.unionByName(lasco).unionByName(secchi)


SQL_FOLDERS = f"""
WITH {_SQL_SPANS},
day AS (SELECT unnest(generate_series(min(first), max(last), INTERVAL 1 DAY)) AS d FROM spans)
SELECT CASE WHEN satellite >= 16
  THEN printf('https://data.ngdc.noaa.gov/platforms/solar-space-observing-satellites/goes/goes%02d/l2/data/xrsf-l2-avg1m/', satellite)
  ELSE printf('https://www.ncei.noaa.gov/data/goes-space-environment-monitor/access/science/xrs/goes%02d/xrsf-l2-avg1m_science/', satellite)
  END || strftime(m, '%Y/%m/') AS folder FROM monthly
UNION ALL SELECT 'https://lasco-www.nrl.navy.mil/lz/level_05/' || strftime(d, '%y%m%d/') || camera
FROM day, (VALUES ('c2'), ('c3')) AS c(camera)
UNION ALL SELECT CASE WHEN datatype = 'science' THEN 'https://stereo-ssc.nascom.nasa.gov/data/ins_data/secchi/L0/' || craft[1]
  || '/img/' ELSE 'https://stereo-ssc.nascom.nasa.gov/data/beacon/' || craft || '/secchi/img/' END || instrument || strftime(d, '/%Y%m%d')
FROM day, (VALUES ('science'), ('beacon')) AS t(datatype), (VALUES ('ahead'), ('behind')) AS s(craft),
  (VALUES ('cor1'), ('euvi')) AS i(instrument)
"""


def yearly_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly files per satellite's mission: the minute records and two index documents."""
    spans = _satellite_spans(spark, sf_dir)
    minutes = yearly_urls(spans, "first", "last", "omni_high_resolution")
    indexes = yearly_urls(spans, "first", "last", "hpo", ("Hp30", "ap30"))
    return minutes.select("satellite", "year", "url").unionByName(indexes.select("satellite", "year", "url"))


SQL_YEARLY = f"""
WITH {_SQL_SPANS}, y AS (SELECT DISTINCT satellite, year(m)::INTEGER AS year FROM monthly)
SELECT satellite, year, 'https://spdf.gsfc.nasa.gov/pub/data/omni/high_res_omni/omni_min' || year || '.asc' AS url FROM y
UNION ALL SELECT satellite, year, 'https://kp.gfz.de/app/json/?start=' || year || '-01-01T00:00:00Z&end=' || year
  || '-12-31T23:59:59Z&index=' || i FROM y, (VALUES ('Hp30'), ('ap30')) AS t(i)
"""


def _satellite_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listed file per order: some of another satellite, some without a date."""
    return table(spark, sf_dir, "orders").selectExpr(
        "CAST(13 + o_custkey % 7 AS INT) AS satellite",
        "'https://x/' AS folder",
        """concat('sci_g', 13 + (o_custkey + IF(o_orderkey % 9 = 0, 1, 0)) % 7,
             IF(o_orderkey % 8 = 0, '_', concat('_d', date_format(o_orderdate, 'yyyyMMdd'), '_')), 'v', o_orderkey, '.nc') AS name""",
        "TIMESTAMP_NTZ'1996-01-01 00:00:00' AS first",
        "TIMESTAMP_NTZ'1999-06-30 00:00:00' AS last",
    )


_SQL_LISTING = """
listing AS (
  SELECT o_orderkey, o_custkey, o_orderdate, (13 + o_custkey % 7)::INTEGER AS satellite,
    'sci_g' || (13 + (o_custkey + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END) % 7)
    || CASE WHEN o_orderkey % 8 = 0 THEN '_' ELSE strftime(o_orderdate, '_d%Y%m%d_') END || 'v' || o_orderkey || '.nc' AS name
  FROM orders
),
wanted AS (
  SELECT * FROM listing WHERE o_orderkey % 9 <> 0 AND o_orderkey % 8 <> 0
   AND o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-06-30'
)
"""


def satellite_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = satellite_files(_satellite_listing(spark, sf_dir), "first", "last")
    return files.select("satellite", "name", "url").orderBy("satellite", "name")


SQL_LISTING = f"WITH {_SQL_LISTING} SELECT satellite, name, 'https://x/' || name AS url FROM wanted"


def satellite_downloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files not yet in the archive; every third is held."""
    listing = _satellite_listing(spark, sf_dir)
    held = satellite_plan(listing, spark.createDataFrame([], "file_path string"), "first", "last", "/goes")
    held = held.where(F.regexp_extract("name", r"v(\d+)\.nc", 1).cast("int") % 3 == 0).select("file_path")
    return satellite_plan(listing, held, "first", "last", "/goes").select("url", "file_path")


SQL_DOWNLOADS = f"""
WITH {_SQL_LISTING}
SELECT 'https://x/' || name AS url, '/goes/g' || satellite || strftime(o_orderdate, '/%Y/') || name AS file_path
FROM wanted WHERE o_orderkey % 3 <> 0
"""


def open_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Targets without an image in range, and the files found for them, spikes left out."""
    from datetime import timedelta

    targets = uncovered_targets(hourly(spark, sf_dir), image_catalog(spark, sf_dir), timedelta(minutes=6))
    found = targets.withColumn(
        "filename",
        F.concat_ws("_", "telescope", "channel", F.date_format("target_time", "yyyyMMddHH"),
                    F.when(F.hour("target_time") % 6 == 0, "SPIKE")),
    )
    return manifest_files(found)


SQL_REQUESTS = f"""
WITH {_SQL_TARGETS}
SELECT telescope, channel, target_time, telescope || '_' || channel || strftime(target_time, '_%Y%m%d%H')
  || CASE WHEN hour(target_time) % 6 = 0 THEN '_SPIKE' ELSE '' END AS filename
FROM targets t WHERE NOT (telescope = 'aia' AND hour(target_time) % 6 = 0) AND NOT EXISTS (
  SELECT 1 FROM catalog c WHERE c.telescope = t.telescope AND c.channel = t.channel AND c.quality = 0
   AND c.datetime BETWEEN t.target_time - INTERVAL 6 MINUTE AND t.target_time + INTERVAL 6 MINUTE)
"""


def archive_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    root = F.lit("/archive")
    return e.select(
        "event_id",
        sdo_folder(root, F.lit("aia"), F.col("ts")).alias("sdo"),
        lasco_folder(root, F.lit("c2"), F.col("ts")).alias("lasco"),
        secchi_folder(root, F.lit("science"), F.lit("ahead"), F.col("event_type"), F.col("ts")).alias("secchi"),
    )


SQL_PATHS = """
SELECT event_id, '/archive/aia' || strftime(ts, '/%Y/%Y%m%d') AS sdo, '/archive/c2' || strftime(ts, '/%Y/%Y%m%d') AS lasco,
  '/archive/science/ahead/' || event_type || strftime(ts, '/%Y/%Y%m%d') AS secchi FROM events
"""


def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first name a part holds, even if its value is missing."""
    held = table(spark, sf_dir, "part").selectExpr(
        "p_partkey",
        """map_from_entries(filter(array(
             IF(p_partkey % 2 = 0, struct('a' AS key, IF(p_partkey % 4 = 0, NULL, p_retailprice) AS value), NULL),
             IF(p_partkey % 3 = 0, struct('b' AS key, p_retailprice * 2 AS value), NULL)), e -> e IS NOT NULL)) AS variables""",
    )
    return held.select("p_partkey", first_existing(F.col("variables"), ("a", "b")).alias("value"))


SQL_ALIAS = """
SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CASE WHEN p_partkey % 4 <> 0 THEN p_retailprice END
  WHEN p_partkey % 3 = 0 THEN p_retailprice * 2 END AS value FROM part
"""

QUERIES = {
    "camera_lookup": camera_lookup,
    "spacecraft_lookup": spacecraft_lookup,
    "dated_rows": dated_rows,
    "file_presence": file_presence,
    "download_plan": download_plan,
    "name_listing": name_listing,
    "first_listed": first_listed,
    "month_grid": month_grid,
    "remote_folders": remote_folders,
    "yearly_files": yearly_files,
    "satellite_listing": satellite_listing,
    "satellite_downloads": satellite_downloads,
    "open_requests": open_requests,
    "archive_paths": archive_paths,
    "alias_resolution": alias_resolution,
}
ORACLES = {
    "camera_lookup": SQL_CAMERA,
    "spacecraft_lookup": SQL_SPACECRAFT,
    "dated_rows": SQL_DATED,
    "file_presence": SQL_PRESENCE,
    "download_plan": SQL_PLAN,
    "name_listing": SQL_NAMES,
    "first_listed": SQL_FIRST,
    "month_grid": SQL_MONTHS,
    "remote_folders": SQL_FOLDERS,
    "yearly_files": SQL_YEARLY,
    "satellite_listing": SQL_LISTING,
    "satellite_downloads": SQL_DOWNLOADS,
    "open_requests": SQL_REQUESTS,
    "archive_paths": SQL_PATHS,
    "alias_resolution": SQL_ALIAS,
}
