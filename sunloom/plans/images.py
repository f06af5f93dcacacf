"""Image catalogues: header maps to records, registration, lookups."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunloom.functions.names import sdo_folder
from sunloom.functions.times import ntz, parse_datetime, parse_record_time, tai_to_utc, time_in_file_name
from sunloom.operators.inserts import first_per_key
from sunloom.operators.reconcile import absent, present
from sunloom.session import materialise
from sunloom.sinks.ledger import HELD, KNOWN, REFUSED, REGISTERED, file_fates, next_run, record_run
from sunloom.sinks.tables import InsertCounts, insert_ignore, quarantine, with_target_path
from sunloom.sources.headers import keyword, with_keywords
from sunloom.tables import TABLES, TableSpec, conform, read_table

# Classes of refused files.
INVALID_FILE = "invalid_file"
INVALID_HEADER = "invalid_header"
INVALID_DATA = "invalid_data"
NON_ZERO_QUALITY = "non_zero_quality"
INVALID_TIME = "invalid_time"


# Header keywords read, in order of preference where several serve.
SDO_KEYWORDS = ("T_REC", "QUALITY", "TELESCOP", "WAVELNTH", "CONTENT")
CAMERA_KEYWORDS = (
    "T_REC", "T_OBS", "DATE-OBS", "DATE_OBS", "TIME-OBS", "TIME_OBS",
    "DETECTOR", "EXPTIME", "EXP_TIME", "FILTER", "FILTER1", "WAVELNTH",
)


def _text(*keys: str) -> Column:
    """First non-empty value of the keyword columns."""
    return F.coalesce(*[F.nullif(F.col(f"`{k}`"), F.lit("")) for k in keys])


def _number(*keys: str) -> Column:
    """First non-zero number of the keyword columns; zero counts as absent."""
    return F.coalesce(*[F.nullif(F.col(f"`{k}`").try_cast("double"), F.lit(0.0)) for k in keys])


def _whole(number: Column) -> Column:
    return number.try_cast("int")


def observation_time(path: Column) -> Column:
    """Record or observation time, else date with or without time, else the file name."""
    day, clock = _text("DATE-OBS", "DATE_OBS"), _text("TIME-OBS", "TIME_OBS")
    dated = F.when(clock.isNotNull(), F.concat_ws(" ", day, clock)).otherwise(day)
    return F.coalesce(
        parse_datetime(_text("T_REC", "T_OBS")),
        F.when(day.isNotNull(), parse_datetime(dated)),
        time_in_file_name(path),
    )


def classify_sdo(units: DataFrame, check_quality: bool = True, has_data: str | None = None) -> DataFrame:
    """``error`` (NULL if valid) and the catalogue columns of a solar-disc image.

    The second header is used if it carries a record time. The boolean column
    ``has_data`` says whether pixels were found; without it that check is left
    out. ``datetime`` is as recorded, not yet shifted to UTC.
    """
    second = F.coalesce(keyword(F.col("unit1"), "T_REC") != "", F.lit(False))
    chosen = units.withColumn("_h", F.when(second, F.col("unit1")).otherwise(F.col("unit0")))
    read = with_keywords(chosen, "_h", SDO_KEYWORDS)
    read = read.withColumns(
        {
            "datetime": parse_record_time(F.col("T_REC")),
            "_quality": F.col("QUALITY").try_cast("double"),
            "_wavelength": _text("WAVELNTH").try_cast("double"),
            "content": _text("CONTENT"),
        }
    )
    absent = F.col("T_REC").isNull() | F.col("QUALITY").isNull() | F.col("TELESCOP").isNull()
    empty = ~F.coalesce(F.col(has_data), F.lit(False)) if has_data else F.lit(False)
    flagged = F.coalesce(F.col("_quality") != 0, F.lit(True)) if check_quality else F.lit(False)
    error = (
        F.when(F.col("unit0").isNull(), INVALID_FILE)
        .when(absent | F.col("datetime").isNull(), INVALID_HEADER)
        .when(empty, INVALID_DATA)
        .when(flagged, NON_ZERO_QUALITY)
        .when(_text("WAVELNTH").isNotNull() & F.col("_wavelength").isNull(), INVALID_HEADER)
    )
    lowered = F.lower("content")
    # The header does not tell the two magnetogram cadences apart.
    hmi = (
        F.when(lowered.isNull() | lowered.contains("magnetogram"), "m_45s")
        .when(lowered.contains("continuum"), "ic_45s")
        .otherwise(F.replace(lowered, F.lit(" "), F.lit("_")))
    )
    judged = read.withColumns(
        {
            "error": error,
            "telescope": F.when(F.upper("TELESCOP").contains("AIA"), "aia").otherwise("hmi"),
            "wavelength": F.when(F.col("_wavelength") != 0, _whole(F.col("_wavelength"))),
        }
    )
    valid = F.col("error").isNull()
    channel = F.when(F.col("telescope") == "aia", F.col("wavelength").cast("string")).otherwise(hmi)
    return judged.select(
        *[c for c in units.columns if c not in ("unit0", "unit1")],
        "error",
        F.when(valid, F.col("telescope")).alias("telescope"),
        F.when(valid, channel).alias("channel"),
        F.when(valid, F.col("datetime")).alias("datetime"),
        F.when(valid, _whole(F.col("_quality"))).alias("quality"),
        F.when(valid, F.col("wavelength")).alias("wavelength"),
        F.when(valid, F.col("content")).alias("content"),
    )


def _camera_headers(units: DataFrame) -> DataFrame:
    read = with_keywords(units, "unit0", CAMERA_KEYWORDS).withColumn("datetime", observation_time(F.col("path")))
    error = F.when(F.col("unit0").isNull(), INVALID_FILE).when(F.col("datetime").isNull(), INVALID_TIME)
    return read.withColumn("error", error)


def lasco_records(units: DataFrame, camera: str | None = None) -> DataFrame:
    """Coronagraph records; a given camera wins over the header's detector."""
    return _camera_headers(units).select(
        "path",
        "error",
        F.coalesce(F.lit(camera), F.lower(_text("DETECTOR"))).alias("camera"),
        "datetime",
        F.col("path").alias("file_path"),
        _number("EXPTIME", "EXP_TIME").alias("exposure_time"),
        _text("FILTER", "FILTER1").alias("filter"),
    )


def secchi_records(units: DataFrame, datatype: Column, spacecraft: Column, instrument: str | None = None) -> DataFrame:
    """Records of the twin spacecraft; only the EUV imager has a channel."""
    detector = F.lower(F.coalesce(F.col("DETECTOR"), F.lit("")))
    wavelength = _whole(_number("WAVELNTH"))
    return _camera_headers(units).select(
        "path",
        "error",
        datatype.alias("datatype"),
        spacecraft.alias("spacecraft"),
        F.coalesce(F.lit(instrument), detector).alias("instrument"),
        F.when(detector == "euvi", wavelength.cast("string")).alias("channel"),
        "datetime",
        F.col("path").alias("file_path"),
        _number("EXPTIME", "EXP_TIME").alias("exposure_time"),
        _text("FILTER", "FILTER1").alias("filter"),
        wavelength.alias("wavelength"),
    )


def sdo_records(classified: DataFrame, archive: str | None = None) -> DataFrame:
    """Valid rows in UTC, filed in the archive or left where they are."""
    valid = classified.where(F.col("error").isNull())
    utc = valid.withColumn("datetime", tai_to_utc(F.col("datetime"), F.col("telescope")))
    if archive is None:
        return utc.withColumn("file_path", F.col("path"))
    return with_target_path(utc, sdo_folder(F.lit(archive), F.col("telescope"), F.col("datetime")))


def split_held(records: DataFrame, held: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """Records to file, and those skipped since another file already has their place."""
    moved = records.where(F.col("path") != F.col("file_path"))
    stays = records.where(F.col("path") == F.col("file_path"))
    places = held.select(F.col(path).alias("file_path"))
    return stays.unionByName(absent(moved, places, "file_path")), present(moved, places, "file_path")


@dataclass(frozen=True)
class Registration:
    inserted: InsertCounts
    refused: int


def register(classified: DataFrame, records: DataFrame, spec: TableSpec, root: str, quarantine_root: str) -> Registration:
    """Store the valid records whose key and path are free, set the others aside.

    Files are taken in path order. Valid records that lack a key part are set aside
    too, as ``missing_key``. ``classified`` should be materialised: it is read by
    both branches.
    """
    # A file listed twice is one file, and insertion wants each place in the order once.
    counts = insert_ignore(first_per_key(records, ["path"], ["file_path", "datetime"]), spec, root, ("path",))
    bad = classified.where(F.col("error").isNotNull()).select("path", "error")
    if counts.refused:
        bad = bad.unionByName(counts.refused_rows.select("path", "error"))
    quarantine(bad, quarantine_root)
    return Registration(counts, classified.where(F.col("error").isNotNull()).count() + counts.refused)


def _placed(records: DataFrame, spec: TableSpec, root: str, ledger: str) -> DataFrame:
    """``path`` of the records that are stored, each place for one file.

    A stored row is a file's own if key and place are equal. Of several such files of one
    place the one the ledger names has it, else the first by path.
    """
    spark = records.sparkSession
    lo, hi = records.agg(F.min("datetime"), F.max("datetime")).first()
    stored = read_table(spark, root, spec)
    if lo is not None:
        stored = stored.where(F.col("datetime").between(ntz(lo), ntz(hi)))
        if spec.partition not in spec.columns:
            stored = stored.where(F.col(spec.partition).between(lo.year, hi.year))
    names = [*spec.key, "file_path"]
    stored = stored.select(*[F.col(c).alias(f"_of_{c}") for c in names])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in spec.key])
    own = conform(records, spec, keep=["path"]).join(stored, same & (F.col("file_path") == F.col("_of_file_path")), "left_semi")
    own = materialise(own.select("path", "file_path"), "placed")
    owners = file_fates(spark, ledger).where(F.col("state") == REGISTERED).select(F.col("path").alias("owner"), "file_path")
    named = own.groupBy("file_path").agg(F.min("path").alias("first"))
    held_by = owners.join(named, "file_path", "left_semi").groupBy("file_path").agg(F.min("owner").alias("owner"))
    holders = named.join(held_by, "file_path", "left").select(F.coalesce("owner", "first").alias("path"))
    return present(own.select("path"), holders, "path")


def register_logged(
    classified: DataFrame,
    records: DataFrame,
    spec: TableSpec,
    root: str,
    ledger: str,
    held: DataFrame | None = None,
    run: int | None = None,
) -> int:
    """Store the valid records whose key and place are free; the fate of every file goes to
    the ledger, as one run whose number is returned.

    Files whose place another file of the listing ``held`` has already are not stored.
    Fates are read off the stored table, so a run that was cut short after storing tells
    the same when it is done again. ``classified`` should be materialised.
    """
    spark = classified.sparkSession
    number = next_run(spark, ledger) if run is None else run
    skipped = None
    if held is not None:
        records, skipped = split_held(records, held)
    # A file listed twice is one file, and insertion wants each place in the order once.
    records = materialise(first_per_key(records, ["path"], ["file_path", "datetime"]), "records")
    counts = insert_ignore(records, spec, root, ("path",))
    stored = _placed(records, spec, root, ledger).select("path", F.lit(REGISTERED).alias("_stored"))
    none = F.lit(None).cast("string").alias("error")
    unfit = counts.refused_rows.select("path", "error") if counts.refused_rows is not None else None
    fates = records.select("path", "file_path").join(stored.distinct(), "path", "left")
    fates = fates.select("path", F.coalesce("_stored", F.lit(KNOWN)).alias("state"), none, "file_path")
    if unfit is not None:
        fates = absent(fates, unfit, "path")
    bad = classified.where(F.col("error").isNotNull()).select("path", "error")
    bad = bad.unionByName(unfit) if unfit is not None else bad
    nowhere = F.lit(None).cast("string").alias("file_path")
    fates = fates.unionByName(bad.select("path", F.lit(REFUSED).alias("state"), "error", nowhere))
    if skipped is not None:
        fates = fates.unionByName(skipped.select("path", F.lit(HELD).alias("state"), none, "file_path"))
    record_run(fates, ledger, number)
    return number


def register_sdo_logged(
    classified: DataFrame, root: str, ledger: str, archive: str | None = None, held: DataFrame | None = None
) -> int:
    """Solar-disc images with a ledger; ``held`` lists the files already in the archive."""
    return register_logged(classified, sdo_records(classified, archive), TABLES["sdo"], root, ledger, held)


def register_sdo(classified: DataFrame, root: str, quarantine_root: str, archive: str | None = None) -> Registration:
    return register(classified, sdo_records(classified, archive), TABLES["sdo"], root, quarantine_root)


def register_lasco(records: DataFrame, root: str, quarantine_root: str) -> Registration:
    return register(records, records.where(F.col("error").isNull()), TABLES["lasco"], root, quarantine_root)


def register_secchi(records: DataFrame, root: str, quarantine_root: str) -> Registration:
    return register(records, records.where(F.col("error").isNull()), TABLES["secchi"], root, quarantine_root)


def camera_images(lasco: DataFrame, camera: str, start: datetime, end: datetime) -> DataFrame:
    held = (F.col("camera") == camera) & F.col("datetime").between(ntz(start), ntz(end))
    return lasco.where(held).orderBy("datetime")


def spacecraft_images(
    secchi: DataFrame,
    datatype: str,
    spacecraft: str,
    instrument: str,
    start: datetime,
    end: datetime,
    channel: str | None = None,
) -> DataFrame:
    held = (
        (F.col("datatype") == datatype)
        & (F.col("spacecraft") == spacecraft)
        & (F.col("instrument") == instrument)
        & F.col("datetime").between(ntz(start), ntz(end))
    )
    if channel:
        held = held & (F.col("channel") == channel)
    return secchi.where(held).orderBy("datetime")


def good_quality(sdo: DataFrame, required: bool = True) -> DataFrame:
    """Quality zero only; an unknown quality does not pass."""
    return sdo.where(F.col("quality") == 0) if required else sdo
