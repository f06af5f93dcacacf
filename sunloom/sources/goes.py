"""Decoded satellite files to time-series rows.

Input is one row per file (``DECODED_FILE``): every variable as flat values with
its shape, decoded time axes apart. Files of several generations may share a
frame; a variable is chosen per file by the first alias the file holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.functions.names import is_r_series
from sunloom.functions.nested import (
    first_existing,
    integral_flux,
    mean_over_sensors,
    nulls_for_nans,
    vector_length,
)
from sunloom.functions.numbers import nan_to_null
from sunloom.functions.stages import computed_once
from sunloom.functions.times import decode_time_axis

VARIABLE = T.StructType(
    [
        T.StructField("shape", T.ArrayType(T.IntegerType())),
        T.StructField("data", T.ArrayType(T.DoubleType())),
    ]
)
DECODED_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("satellite", T.ShortType()),
        T.StructField("times", T.MapType(T.StringType(), T.ArrayType(T.TimestampNTZType()))),
        T.StructField("variables", T.MapType(T.StringType(), VARIABLE)),
        T.StructField("units", T.MapType(T.StringType(), T.StringType())),
    ]
)

# Variable names by product generation, in order of preference.
XRS_CHANNELS = {
    "xrs_a_flux_w_m2": ("xrsa_flux", "a_flux", "xrs_a_flux", "xrsa_primary_chan_flux"),
    "xrs_b_flux_w_m2": ("xrsb_flux", "b_flux", "xrs_b_flux", "xrsb_primary_chan_flux"),
    "xrs_a1_flux_w_m2": ("xrsa1_flux", "a1_flux"),
    "xrs_a2_flux_w_m2": ("xrsa2_flux", "a2_flux"),
    "xrs_b1_flux_w_m2": ("xrsb1_flux", "b1_flux"),
    "xrs_b2_flux_w_m2": ("xrsb2_flux", "b2_flux"),
    "xrs_a_flag": ("xrsa_flags", "a_flags", "xrsa_flag", "a_flag"),
    "xrs_b_flag": ("xrsb_flags", "b_flags", "xrsb_flag", "b_flag"),
}
MAG_FRAMES = {
    "EPN": ("b_epn", (("b_epn_x", "bx_epn"), ("b_epn_y", "by_epn"), ("b_epn_z", "bz_epn"))),
    "GSE": ("b_gse", (("b_gse_x", "bx_gse"), ("b_gse_y", "by_gse"), ("b_gse_z", "bz_gse"))),
    "GSM": (
        "b_gsm",
        (("b_gsm_x", "bx_gsm", "h_gsm"), ("b_gsm_y", "by_gsm", "e_gsm"), ("b_gsm_z", "bz_gsm", "n_gsm")),
    ),
    "VDH": (
        "b_vdh",
        (
            ("b_vdh_v", "bv_vdh", "hp", "bv"),
            ("b_vdh_d", "bd_vdh", "he", "bd"),
            ("b_vdh_h", "bh_vdh", "hn", "bh"),
        ),
    ),
}
MAG_TOTAL = ("b_total", "bt", "btotal", "b_magnitude")
MAG_FLAG = ("b_flags", "b_flag", "mag_flags", "mag_flag", "DQF", "b_quality")
PROTON_THRESHOLDS_MEV = (1, 5, 10, 30, 50, 60, 100)
PROTON_NAMES = (
    "proton_flux_gt{0}mev",
    "P_GT_{0}",
    "PGT{0}",
    "p_gt{0}",
    "avgintprotonflux_gt{0}mev",
    "IntegralProtonFlux_gt{0}MeV",
)
PROTON_FLAG = ("proton_flags", "proton_flag", "p_flags", "DQF", "IntDQFerrSum")
PROTON_DIFFERENTIAL = "AvgDiffProtonFlux"
PROTON_LOWER = "DiffProtonLowerEnergy"
PROTON_UPPER = "DiffProtonUpperEnergy"
TIME_NAMES = ("time", "L2_SciData_TimeStamp")


def time_axis(names: Sequence[str]) -> Column:
    """Times of the first axis the file holds; a raw axis is decoded by its units."""
    picked = F.when(F.lit(False), F.col("times")[names[0]])
    for name in names:
        raw = decode_time_axis(F.col("variables")[name]["data"], F.col("units")[name])
        picked = picked.when(F.map_contains_key("times", name), F.col("times")[name])
        picked = picked.when(F.map_contains_key("variables", name), raw)
    return picked


def _variable(names: Sequence[str]) -> Column:
    return first_existing(F.col("variables"), names)


def one_dimensional(variable: Column) -> Column:
    """Values of a ``(n)`` or ``(n, 1)`` variable, else NULL."""
    shape = variable["shape"]
    flat = (F.size(shape) == 1) | ((F.size(shape) == 2) & (F.get(shape, F.lit(1)) == 1))
    return F.when(flat, nulls_for_nans(variable["data"]))


def series(names: Sequence[str]) -> Column:
    """Series as long as the time axis ``t``, else NULL."""
    values = one_dimensional(_variable(names))
    return F.when(F.size(values) == F.size("t"), values)


def _with_times(files: DataFrame, names: Sequence[str]) -> DataFrame:
    """Files without a usable time axis give no rows."""
    return computed_once(files, {"t": time_axis(names)}).where(F.size("t") > 0)


def _unnest(files: DataFrame, names: Sequence[str], per_file: Sequence[str] = ()) -> DataFrame:
    """One row per time step, tagged by file and step; an absent series is NULL throughout.

    The series are zipped before they are spread, so a row carries its own values
    and not the arrays of its file.
    """
    filled = files.select(
        "path",
        "satellite",
        *per_file,
        F.col("t").alias("datetime"),
        *[F.coalesce(F.col(n), F.array().cast(files.schema[n].dataType)).alias(n) for n in names],
    )
    zipped = F.posexplode(F.arrays_zip("datetime", *names)).alias("step", "_at")
    spread = filled.select("path", "satellite", *per_file, zipped)
    return spread.select("path", "step", "satellite", *[f"_at.{n}" for n in ("datetime", *names)], *per_file)


def xrs_rows(files: DataFrame) -> DataFrame:
    """X-ray flux rows: two primary and four redundant channels, two flags."""
    timed = _with_times(files, ("time",))
    chosen = timed.select("*", *[series(aliases).alias(name) for name, aliases in XRS_CHANNELS.items()])
    return _unnest(chosen, list(XRS_CHANNELS)).withColumn("is_goes_r", is_r_series(F.col("satellite")))


def _packed(names: Sequence[str]) -> Column:
    """Flat values of a packed ``(n, 3)`` variable, else NULL."""
    variable = _variable(names)
    shape = variable["shape"]
    return F.when((F.size(shape) == 2) & (F.get(shape, F.lit(1)) == 3), variable["data"])


def _every_third(packed: Column, i: int) -> Column:
    """Component ``i`` of a packed vector, given as a plain column."""
    rows = F.floor(F.size(packed) / 3).cast("int")
    picked = F.transform(F.sequence(F.lit(0), rows - 1), lambda k: nan_to_null(F.get(packed, k * 3 + i)))
    return F.when(rows > 0, picked)


def mag_rows(files: DataFrame) -> DataFrame:
    """Field rows in the best frame the file holds complete.

    Without a complete frame the components of the last one are kept as far as
    they go, under the frame name UNKNOWN.
    """
    timed = _with_times(files, ("time",))
    packed = computed_once(timed, {f"{frame}_packed": _packed((name,)) for frame, (name, _) in MAG_FRAMES.items()})
    vectors = {}
    for frame, (_, components) in MAG_FRAMES.items():
        whole = F.col(f"{frame}_packed")
        for i, names in enumerate(components):
            alone = one_dimensional(_variable(names))
            vectors[f"{frame}_{i}"] = F.when(whole.isNotNull(), _every_third(whole, i)).otherwise(alone)
    split = computed_once(packed, vectors)

    n = F.size("t")
    chosen = F.when(F.lit(False), F.lit(""))
    for frame in MAG_FRAMES:
        complete = F.lit(True)
        for i in range(3):
            complete = complete & F.coalesce(F.size(f"{frame}_{i}") == n, F.lit(False))
        chosen = chosen.when(complete, frame)
    framed = computed_once(split, {"frame": chosen})

    last = list(MAG_FRAMES)[-1]
    columns = {}
    for i, name in enumerate(("bx_nt", "by_nt", "bz_nt")):
        value = F.when(F.col("frame").isNull() & (F.size(f"{last}_{i}") == n), F.col(f"{last}_{i}"))
        for frame in MAG_FRAMES:
            value = value.when(F.col("frame") == frame, F.col(f"{frame}_{i}"))
        columns[name] = value
    columns |= {"total": series(MAG_TOTAL), "mag_flag": series(MAG_FLAG)}
    ready = framed.select(
        "path", "satellite", "t", "frame", *[value.alias(name) for name, value in columns.items()]
    ).withColumn("has_total", F.col("total").isNotNull())
    rows = _unnest(ready, list(columns), ("frame", "has_total"))
    length = vector_length(F.col("bx_nt"), F.col("by_nt"), F.col("bz_nt"))
    return rows.select(
        "path",
        "step",
        "satellite",
        "datetime",
        "bx_nt",
        "by_nt",
        "bz_nt",
        F.when(F.col("has_total"), F.col("total")).otherwise(length).alias("bt_nt"),
        F.coalesce("frame", F.lit("UNKNOWN")).alias("coord_frame"),
        "mag_flag",
    )


def _channel_bounds(prefix: str) -> Column:
    """Channel bounds; a (sensor, channel) table is averaged over its sensors."""
    data, shape = F.col(f"{prefix}_data"), F.col(f"{prefix}_shape")
    table = (F.size(shape) == 2) & (F.get(shape, F.lit(0)) > 0) & (F.get(shape, F.lit(1)) > 0)
    mean = mean_over_sensors(data, F.get(shape, F.lit(0)), F.get(shape, F.lit(1)), F.lit(0))
    return F.when(table, mean).when(F.size(shape) == 1, data)


def proton_rows(files: DataFrame) -> DataFrame:
    """Integral flux above seven energies.

    Files with differential flux and energy bounds that fit are integrated; all
    others give the per-threshold series they name.
    """
    timed = _with_times(files, TIME_NAMES)
    sources = {"flux": PROTON_DIFFERENTIAL, "lower": PROTON_LOWER, "upper": PROTON_UPPER}
    flat = {}
    for prefix, name in sources.items():
        flat[f"{prefix}_data"] = nulls_for_nans(F.col("variables")[name]["data"])
        flat[f"{prefix}_shape"] = F.col("variables")[name]["shape"]
    opened = computed_once(timed, flat)
    bounded = computed_once(opened, {"lower": _channel_bounds("lower"), "upper": _channel_bounds("upper")})

    shape = F.col("flux_shape")
    channels = F.get(shape, F.size(shape) - 1)
    sensors = F.when(F.size(shape) == 3, F.get(shape, F.lit(1))).otherwise(1)
    fits = (
        F.size(shape).isin(2, 3)
        & (F.get(shape, F.lit(0)) == F.size("t"))
        & (channels == F.size("lower"))
        & (channels == F.size("upper"))
        & (channels > 0)
        & (sensors > 0)
    )
    judged = computed_once(
        bounded, {"integrate": F.coalesce(fits, F.lit(False)), "channels": channels, "sensors": sensors}
    )
    means = F.transform(
        F.sequence(F.lit(0), F.size("t") - 1),
        lambda k: mean_over_sensors(
            F.col("flux_data"), F.col("sensors"), F.col("channels"), k * F.col("sensors") * F.col("channels")
        ),
    )
    named = {f"proton_flux_gt{mev}mev": [n.format(mev) for n in PROTON_NAMES] for mev in PROTON_THRESHOLDS_MEV}
    ready = judged.select(
        "path",
        "satellite",
        "t",
        "integrate",
        "lower",
        "upper",
        F.when(F.col("integrate"), means).alias("flux"),
        *[series(aliases).alias(name) for name, aliases in {**named, "proton_flag": PROTON_FLAG}.items()],
    )
    rows = _unnest(ready, ["flux", *named, "proton_flag"], ("integrate", "lower", "upper"))
    out = [
        F.when(F.col("integrate"), integral_flux(F.col("flux"), F.col("lower"), F.col("upper"), mev))
        .otherwise(F.col(f"proton_flux_gt{mev}mev"))
        .alias(f"proton_flux_gt{mev}mev")
        for mev in PROTON_THRESHOLDS_MEV
    ]
    return rows.select("path", "step", "satellite", "datetime", *out, "proton_flag")


NORMALISERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "xrs": xrs_rows,
    "mag": mag_rows,
    "proton": proton_rows,
}
INSTRUMENT_TABLES = {"xrs": "goes_xrs", "mag": "goes_mag", "proton": "goes_proton"}


def normaliser(instrument: str) -> Callable[[DataFrame], DataFrame]:
    if instrument not in NORMALISERS:
        raise ValueError(f"unknown instrument {instrument!r}; known: {sorted(NORMALISERS)}")
    return NORMALISERS[instrument]
