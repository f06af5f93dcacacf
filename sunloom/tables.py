"""The twelve stored tables: columns, keys, partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom import versions
from sunloom.functions.numbers import storage_cast
from sunloom.sources.goes import PROTON_THRESHOLDS_MEV, XRS_CHANNELS
from sunloom.sources.hpo import HP30, HP60, IndexSpec
from sunloom.sources.layouts import FIVE_MINUTE, HOURLY, MINUTE, RecordLayout


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def partition(self) -> str:
        """Folder column: the stored year, or one derived from the timestamp."""
        return "year" if "year" in self.columns else "datetime_year"


def _struct(columns: dict[str, T.DataType], required: tuple[str, ...]) -> T.StructType:
    return T.StructType([T.StructField(n, t, n not in required) for n, t in columns.items()])


TIME = T.TimestampNTZType()
REAL, SMALL, INT, TEXT = T.FloatType(), T.ShortType(), T.IntegerType(), T.StringType()

# Integer record fields stored as small integers.
SMALL_FIELDS = {"imf_sc_id", "sw_plasma_sc_id", "kp_index", "flag"}
TIME_FIELDS = {"year", "decimal_day", "day", "hour", "minute"}

STATISTICS = ("avg", "min", "max")
# Short name to source column of the minute table. Note that bx is
# in one frame and by, bz in another.
SOLAR_WIND_VARIABLES = {
    "v": "flow_speed_km_s",
    "np": "proton_density_n_cc",
    "t": "temperature_k",
    "bx": "bx_gse_nt",
    "by": "by_gsm_nt",
    "bz": "bz_gsm_nt",
    "bt": "b_magnitude_nt",
}


def _record_table(layout: RecordLayout) -> TableSpec:
    columns: dict[str, T.DataType] = {"datetime": TIME}
    for field in layout.fields:
        name = field.name.lower()
        columns[name] = (SMALL if name in SMALL_FIELDS else INT) if field.decimals is None else REAL
    required = tuple(n for n in columns if n in TIME_FIELDS)
    return TableSpec(layout.table, _struct(columns, ("datetime", *required)), ("datetime",))


def _index_table(spec: IndexSpec) -> TableSpec:
    columns = {
        "datetime": TIME, "year": SMALL, "month": SMALL, "day": SMALL, "hh_start": REAL,
        spec.hp.lower(): REAL, spec.ap.lower(): SMALL,
    }
    return TableSpec(spec.table, _struct(columns, ("datetime", "year", "month", "day", "hh_start")), ("datetime",))


def _satellite_table(name: str, columns: dict[str, T.DataType], required: tuple[str, ...] = ()) -> TableSpec:
    head = {"satellite": SMALL, "datetime": TIME}
    return TableSpec(name, _struct({**head, **columns}, (*head, *required)), ("satellite", "datetime"))


def _image_table(name: str, columns: dict[str, T.DataType], key: tuple[str, ...], nullable: tuple[str, ...] = ()) -> TableSpec:
    required = tuple(c for c in (*key, "file_path") if c not in nullable)
    return TableSpec(name, _struct(columns, required), key, ("file_path",))


SW30_COLUMNS = [
    "datetime",
    *[f"{short}_{stat}" for short in SOLAR_WIND_VARIABLES for stat in STATISTICS],
    "ap30",
    "hp30",
]

TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _record_table(HOURLY),
        _record_table(MINUTE),
        _record_table(FIVE_MINUTE),
        _index_table(HP30),
        _index_table(HP60),
        _satellite_table(
            "goes_xrs",
            {**{n: SMALL if n.endswith("flag") else REAL for n in XRS_CHANNELS}, "is_goes_r": T.BooleanType()},
            ("is_goes_r",),
        ),
        _satellite_table(
            "goes_mag",
            {"bx_nt": REAL, "by_nt": REAL, "bz_nt": REAL, "bt_nt": REAL, "coord_frame": TEXT, "mag_flag": INT},
        ),
        _satellite_table(
            "goes_proton",
            {**{f"proton_flux_gt{mev}mev": REAL for mev in PROTON_THRESHOLDS_MEV}, "proton_flag": SMALL},
        ),
        TableSpec(
            "sw_30min",
            _struct(
                {n: TIME if n == "datetime" else SMALL if n == "ap30" else REAL for n in SW30_COLUMNS}, ("datetime",)
            ),
            ("datetime",),
        ),
        _image_table(
            "lasco",
            {"camera": TEXT, "datetime": TIME, "file_path": TEXT, "exposure_time": REAL, "filter": TEXT},
            ("camera", "datetime"),
        ),
        _image_table(
            "sdo",
            {
                "telescope": TEXT, "channel": TEXT, "datetime": TIME, "file_path": TEXT,
                "quality": INT, "wavelength": INT, "exposure_time": REAL,
            },
            ("telescope", "channel", "datetime"),
        ),
        # Only one of the instruments has channels: the key is compared null-safe.
        _image_table(
            "secchi",
            {
                "datatype": TEXT, "spacecraft": TEXT, "instrument": TEXT, "channel": TEXT, "datetime": TIME,
                "file_path": TEXT, "exposure_time": REAL, "filter": TEXT, "wavelength": INT,
            },
            ("datatype", "spacecraft", "instrument", "channel", "datetime"),
            ("channel",),
        ),
    )
}


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def conform(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Declared columns, order and types; NaN becomes NULL, absent columns are NULL.

    ``keep`` names further columns to carry along unchanged.
    """
    df = lower_names(df)
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in spec.schema.fields:
        if field.name not in have:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(field.name)
        if isinstance(have[field.name], (T.FloatType, T.DoubleType)):
            value = F.when(~F.isnan(value), value)
        out.append(storage_cast(value, have[field.name], field.dataType).alias(field.name))
    return df.select(*out, *[c for c in keep if c not in spec.columns])


def split_unkeyed(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Rows fit to store, and rows whose required columns are missing (``missing_key``)."""
    required = [f.name for f in spec.schema.fields if not f.nullable]
    lacks = F.lit(False)
    for name in required:
        lacks = lacks | F.col(name).isNull()
    return df.where(~lacks), df.where(lacks).withColumn("error", F.lit("missing_key"))


def with_partition(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df if spec.partition in df.columns else df.withColumn(spec.partition, F.year("datetime"))


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def table_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def stored_schema(spec: TableSpec) -> T.StructType:
    """The declared columns, with the partition column last."""
    fields = {f.name: T.StructField(f.name, f.dataType) for f in spec.schema.fields}
    last = fields.pop(spec.partition, T.StructField(spec.partition, T.IntegerType()))
    return T.StructType([*fields.values(), last])


def ensure_tables(spark: SparkSession, root: str, specs: list[TableSpec] | None = None, drop: bool = False) -> list[str]:
    """Create the declared tables that are absent; ``drop`` empties those present."""
    made = []
    for spec in specs or list(TABLES.values()):
        path = table_path(root, spec.name)
        while True:
            version = versions.latest(spark, path)
            if version is not None and not drop:
                break
            base = version or versions.Version()
            try:
                versions.publish(spark, path, base, drop=base.parts)
            except versions.Conflict:
                continue
            made.append(spec.name)
            break
    return made


def read_table(
    spark: SparkSession, root: str, spec: TableSpec, version: versions.Version | int | None = None
) -> DataFrame:
    """The latest, or a given, version in declared column order, partition column last."""
    path = table_path(root, spec.name)
    if isinstance(version, int):
        version = versions.load(spark, path, version)
    held = version or versions.latest(spark, path)
    if held is None:
        raise FileNotFoundError(f"no table at {path}")
    frame = versions.read_parts(spark, path, held.parts, stored_schema(spec))
    extra = [spec.partition] if spec.partition not in spec.columns else []
    return frame.select(*spec.columns, *extra)
