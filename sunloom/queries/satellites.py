"""Decoded satellite files, made of the embeddings: eight time steps per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.nested import vector_length
from sunloom.plans.ingest import register_satellite
from sunloom.queries.inputs import spread, table
from sunloom.session import scratch_path
from sunloom.sources.goes import DECODED_FILE, PROTON_THRESHOLDS_MEV, XRS_CHANNELS, normaliser
from sunloom.tables import TABLES, read_table

STEPS = 8
_FIRST = "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, CAST(vec_id * 8 AS INT))"
_TIMES = f"transform(sequence(0, {STEPS - 1}), i -> {_FIRST} + make_dt_interval(0, 0, i))"
_SECONDS = f"transform(sequence(0, {STEPS - 1}), i -> CAST(757339200 + (vec_id * 8 + i) * 60 AS DOUBLE))"
_NO_TIMES = "CAST(map() AS map<string, array<timestamp_ntz>>)"


def _part(start: int, length: int = STEPS) -> str:
    return f"slice(v, {start}, {length})"


def _entry(name: str, data: str, *shape: int, when: str = "true") -> str:
    """Map entry of one variable, left out unless the condition holds."""
    dims = ", ".join(map(str, shape or (STEPS,)))
    return f"CASE WHEN {when} THEN struct('{name}' AS key, struct(array({dims}) AS shape, {data} AS data) AS value) END"


def _files(spark: SparkSession, sf_dir: str, entries: list[str], raw_time: str = "false") -> DataFrame:
    rows = spread(table(spark, sf_dir, "embeddings")).selectExpr("vec_id", "transform(embedding, x -> CAST(x AS DOUBLE)) AS v")
    entries = [*entries, _entry("L2_SciData_TimeStamp", _SECONDS, when=raw_time)]
    files = rows.selectExpr(
        "concat('/in/', lpad(vec_id, 9, '0'), '.nc') AS path",
        "CAST(13 + vec_id % 7 AS SMALLINT) AS satellite",
        f"CASE WHEN vec_id % 17 = 0 OR {raw_time} THEN {_NO_TIMES} ELSE map('time', {_TIMES}) END AS times",
        f"map_from_entries(filter(array({', '.join(entries)}), e -> e IS NOT NULL)) AS variables",
        "map('L2_SciData_TimeStamp', 'seconds since 2000-01-01 12:00:00 UTC') AS units",
    )
    return files.select(*[F.col(f.name).cast(f.dataType) for f in DECODED_FILE.fields])


def xrs_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    nans = f"transform({_part(1)}, x -> double('NaN'))"
    r = "vec_id % 7 >= 3"
    return _files(
        spark,
        sf_dir,
        [
            # A first name without values still wins over a second one with values.
            _entry("xrsa_flux", f"CASE WHEN vec_id % 4 = 0 THEN {nans} ELSE {_part(1)} END", when=r),
            _entry("a_flux", _part(9)),
            _entry("b_flux", _part(17), STEPS, 1, when="vec_id % 3 = 0"),
            _entry("xrs_b_flux", _part(25), when="vec_id % 3 = 1"),
            _entry("xrsb_primary_chan_flux", _part(25, 7), 7, when="vec_id % 3 = 2"),
            _entry("xrsa1_flux", _part(33), when=r),
            _entry("a2_flux", _part(33, 16), STEPS, 2, when=r),
            _entry("xrsb_flags", f"transform(sequence(0, {STEPS - 1}), i -> double(i % 3))"),
        ],
    )


SQL_STEPS = """
files AS (SELECT vec_id, 13 + vec_id % 7 AS satellite, embedding AS v FROM embeddings WHERE vec_id % 17 <> 0),
steps AS (
  SELECT *, printf('/in/%09d.nc', vec_id) AS path, TIMESTAMP '2024-01-01' + to_minutes((vec_id * 8 + k)::INTEGER) AS datetime
  FROM files, range(8) AS r(k)
)
"""
SQL_XRS = f"""
WITH {SQL_STEPS}
SELECT path, k::INTEGER AS step, satellite::SMALLINT AS satellite, datetime,
  CASE WHEN satellite < 16 THEN v[9 + k]::DOUBLE WHEN vec_id % 4 <> 0 THEN v[1 + k]::DOUBLE END AS xrs_a_flux_w_m2,
  CASE vec_id % 3 WHEN 0 THEN v[17 + k]::DOUBLE WHEN 1 THEN v[25 + k]::DOUBLE END AS xrs_b_flux_w_m2,
  CASE WHEN satellite >= 16 THEN v[33 + k]::DOUBLE END AS xrs_a1_flux_w_m2,
  NULL::DOUBLE AS xrs_a2_flux_w_m2, NULL::DOUBLE AS xrs_b1_flux_w_m2, NULL::DOUBLE AS xrs_b2_flux_w_m2,
  NULL::DOUBLE AS xrs_a_flag, (k % 3)::DOUBLE AS xrs_b_flag, satellite >= 16 AS is_goes_r
FROM steps
"""


def xrs_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normaliser("xrs")(xrs_files(spark, sf_dir))


def mag_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = "vec_id % 5 = {}".format
    return _files(
        spark,
        sf_dir,
        [
            _entry("b_epn", f"CASE WHEN {kind(0)} THEN {_part(1, 24)} ELSE {_part(1, 21)} END", 8, 3, when=kind(0)),
            _entry("b_epn_x", _part(1), when=kind(4)),
            _entry("b_gse", _part(1, 16), 8, 2, when=kind(3)),
            _entry("bx_gsm", _part(9), when=kind(1)),
            _entry("e_gsm", _part(17), when=kind(1)),
            _entry("b_gsm_z", _part(25), when=kind(1)),
            _entry("hp", _part(33), when=f"{kind(2)} OR {kind(3)}"),
            _entry("he", _part(41), when=f"{kind(2)} OR {kind(3)}"),
            _entry("bh", _part(49), when=kind(3)),
            _entry("bx_gse", _part(9), when=kind(4)),
            _entry("by_gse", _part(17), when=kind(4)),
            _entry("bz_gse", _part(25), 8, 1, when=kind(4)),
            _entry("btotal", _part(57), when="vec_id % 2 = 0"),
            _entry("DQF", f"transform(sequence(0, {STEPS - 1}), i -> double(i))", when="vec_id % 3 = 0"),
        ],
    )


SQL_MAG = f"""
WITH {SQL_STEPS},
b AS (
  SELECT *, vec_id % 5 AS kind,
    (CASE vec_id % 5 WHEN 0 THEN v[3 * k + 1] WHEN 2 THEN v[33 + k] WHEN 3 THEN v[33 + k] ELSE v[9 + k] END)::DOUBLE AS bx,
    (CASE vec_id % 5 WHEN 0 THEN v[3 * k + 2] WHEN 2 THEN v[41 + k] WHEN 3 THEN v[41 + k] ELSE v[17 + k] END)::DOUBLE AS b_y,
    (CASE vec_id % 5 WHEN 0 THEN v[3 * k + 3] WHEN 2 THEN NULL WHEN 3 THEN v[49 + k] ELSE v[25 + k] END)::DOUBLE AS bz
  FROM steps
)
SELECT path, k::INTEGER AS step, satellite::SMALLINT AS satellite, datetime, bx AS bx_nt, b_y AS by_nt, bz AS bz_nt,
  CASE WHEN vec_id % 2 = 0 THEN v[57 + k]::DOUBLE ELSE sqrt(bx * bx + b_y * b_y + bz * bz) END AS bt_nt,
  CASE kind WHEN 0 THEN 'EPN' WHEN 1 THEN 'GSM' WHEN 2 THEN 'UNKNOWN' WHEN 3 THEN 'VDH' ELSE 'GSE' END AS coord_frame,
  CASE WHEN vec_id % 3 = 0 THEN k::DOUBLE END AS mag_flag
FROM b
"""


def mag_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normaliser("mag")(mag_files(spark, sf_dir))


_LOWER = (500, 5000, 20000, 60000)
_UPPER = (5000, 20000, 60000, 80000)


def _bounds(values: tuple[int, ...]) -> str:
    return f"array({', '.join(f'{float(v + 10 * s)}D' for s in range(2) for v in values)})"


def proton_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    differential = "vec_id % 3 = 0"
    holed = "transform(v, x -> CASE WHEN x < -0.05 THEN double('NaN') ELSE x END)"
    return _files(
        spark,
        sf_dir,
        [
            _entry("AvgDiffProtonFlux", holed, STEPS, 2, 4, when=differential),
            _entry("DiffProtonLowerEnergy", _bounds(_LOWER), 2, 4, when=differential),
            _entry("DiffProtonUpperEnergy", _bounds(_UPPER), 2, 4, when=differential),
            _entry("P_GT_10", _part(1)),
            _entry("PGT30", _part(9), when="vec_id % 3 = 1"),
            _entry("p_gt60", _part(17), STEPS, 1),
            _entry("IntDQFerrSum", f"transform(sequence(0, {STEPS - 1}), i -> double(i))"),
        ],
        raw_time="vec_id % 6 = 1",
    )


def _integral_sql(mev: int) -> str:
    terms, reach = [], []
    for c, (lo, up) in enumerate(zip(_LOWER, _UPPER)):
        width = max(0.0, (up + 5.0) - max(mev * 1000.0, lo + 5.0))
        reach.append(width)
        terms.append(f"coalesce(m{c} * {width}::DOUBLE, 0)")
    if not sum(reach):
        return "NULL"
    return f"CASE WHEN coalesce(m0, m1, m2, m3) IS NOT NULL THEN 0::DOUBLE + {' + '.join(terms)} END"


_NAMED_SQL = {10: "v[1 + k]::DOUBLE", 30: "CASE WHEN vec_id % 3 = 1 THEN v[9 + k]::DOUBLE END", 60: "v[17 + k]::DOUBLE"}
SQL_PROTON = f"""
WITH {SQL_STEPS.replace('vec_id % 17 <> 0', 'vec_id % 17 <> 0 OR vec_id % 6 = 1')},
x AS (
  SELECT *, {', '.join(f'''CASE WHEN v[k * 8 + {4 * s + c + 1}] >= -0.05 THEN v[k * 8 + {4 * s + c + 1}]::DOUBLE END AS x{s}{c}'''
                       for s in range(2) for c in range(4))} FROM steps
),
m AS (
  SELECT *, {', '.join(f'''CASE WHEN x0{c} IS NULL THEN x1{c} WHEN x1{c} IS NULL THEN x0{c} ELSE (x0{c} + x1{c}) / 2 END AS m{c}'''
                       for c in range(4))} FROM x
)
SELECT path, k::INTEGER AS step, satellite::SMALLINT AS satellite, datetime,
  {', '.join(f"CASE WHEN vec_id % 3 = 0 THEN {_integral_sql(mev)} ELSE {_NAMED_SQL.get(mev, 'NULL')} END::DOUBLE AS proton_flux_gt{mev}mev"
             for mev in PROTON_THRESHOLDS_MEV)},
  k::DOUBLE AS proton_flag
FROM m
"""


def proton_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normaliser("proton")(proton_files(spark, sf_dir))


def vector_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    parts = [F.col("embedding")[i].cast("double") for i in range(3)]
    return rows.select("vec_id", vector_length(*parts).alias("total"))


SQL_VECTOR = """
SELECT vec_id, sqrt(embedding[1]::DOUBLE * embedding[1]::DOUBLE + embedding[2]::DOUBLE * embedding[2]::DOUBLE
  + embedding[3]::DOUBLE * embedding[3]::DOUBLE) AS total FROM embeddings
"""


def xrs_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in two overlapping runs, as stored; the second run adds only what is new."""
    root, files = scratch_path(spark, "xrs"), xrs_files(spark, sf_dir)
    register_satellite(files.where("path < '/in/000000100.nc'"), "xrs", root)
    register_satellite(files, "xrs", root)
    stored = read_table(spark, root, TABLES["goes_xrs"]).drop("datetime_year")
    return stored.withColumns({c: F.col(c).cast("double") for c in ("xrs_a_flag", "xrs_b_flag")})


SQL_XRS_REGISTERED = f"""
WITH rows_in AS ({SQL_XRS})
SELECT satellite, datetime, {', '.join(
    c if c.endswith('flag') else f'{c}::FLOAT AS {c}' for c in XRS_CHANNELS)}, is_goes_r FROM rows_in
"""


def xrs_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, parsed, failed and rows per satellite, with a total line (satellite -1)."""
    _, totals = register_satellite(xrs_files(spark, sf_dir), "xrs", scratch_path(spark, "xrs"))
    return totals.withColumn("satellite", F.coalesce(F.col("satellite").cast("int"), F.lit(-1)))


SQL_RUN_TOTALS = """
SELECT coalesce((13 + vec_id % 7)::INTEGER, -1) AS satellite, count(*) AS files,
  count(*) FILTER (vec_id % 17 <> 0) AS parsed, count(*) FILTER (vec_id % 17 = 0) AS failed,
  8 * count(*) FILTER (vec_id % 17 <> 0) AS rows_inserted
FROM embeddings GROUP BY ROLLUP ((13 + vec_id % 7)::INTEGER)
"""

QUERIES = {
    "xrs_normalised": xrs_normalised,
    "mag_normalised": mag_normalised,
    "proton_normalised": proton_normalised,
    "vector_total": vector_total,
    "xrs_registered": xrs_registered,
    "xrs_run_totals": xrs_run_totals,
}
ORACLES = {
    "xrs_normalised": SQL_XRS,
    "mag_normalised": SQL_MAG,
    "proton_normalised": SQL_PROTON,
    "vector_total": SQL_VECTOR,
    "xrs_registered": SQL_XRS_REGISTERED,
    "xrs_run_totals": SQL_RUN_TOTALS,
}
