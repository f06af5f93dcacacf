"""What to fetch: wanted remote files against what is already held."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunloom.functions.names import (
    AIA_CHANNELS,
    CATEGORIES,
    DATATYPES,
    HMI_CHANNELS,
    SECCHI_INSTRUMENTS,
    SPACECRAFT,
    URL_TEMPLATES,
    fill_template,
    goes_path,
    goes_url,
    is_spike,
    lasco_url,
    satellite_tag,
    secchi_url,
)
from sunloom.functions.times import date_in_file_name
from sunloom.operators.grids import days, months, with_options
from sunloom.operators.reconcile import wanted_files
from sunloom.operators.timejoin import covered
from sunloom.plans.images import good_quality

SDO_CHANNELS = {"aia": AIA_CHANNELS, "hmi": HMI_CHANNELS}


def yearly_urls(spans: DataFrame, start: str, end: str, dataset: str, indexes: Sequence[str] = ()) -> DataFrame:
    """Remote file per year of a span, and per index where the source serves them one by one."""
    first, last = F.year(start), F.year(end)
    yearly = spans.withColumn("year", F.explode(F.when(first <= last, F.sequence(first, last))))
    parts = {"year": F.col("year")}
    if indexes:
        yearly = with_options(yearly, index=indexes)
        parts["index"] = F.col("index")
    return yearly.withColumn("url", fill_template(URL_TEMPLATES[dataset], **parts))


def satellite_folders(spans: DataFrame, instrument: str, start: str, end: str) -> DataFrame:
    """Remote folder per satellite and month; ``spans`` has ``satellite`` and two dates."""
    monthly = months(spans, start, end)
    return monthly.withColumn("folder", goes_url(instrument, F.col("satellite"), F.col("year"), F.col("month")))


def satellite_files(listing: DataFrame, start: str, end: str) -> DataFrame:
    """Listed files that carry the satellite's tag and a date inside the closed span."""
    day = date_in_file_name(F.col("name"))
    tagged = F.lower("name").contains(satellite_tag(F.col("satellite")))
    inside = day.between(F.col(start).cast("date"), F.col(end).cast("date"))
    return listing.where(tagged & inside).withColumn("url", F.concat("folder", "name"))


def satellite_plan(listing: DataFrame, held: DataFrame, start: str, end: str, archive: str, overwrite: bool = False) -> DataFrame:
    """Files to fetch with the place each belongs to."""
    files = satellite_files(listing, start, end)
    files = files.withColumn("file_path", goes_path(F.lit(archive), F.col("satellite"), F.col("name")))
    return wanted_files(files, held, "file_path", overwrite)


def coronagraph_folders(spans: DataFrame, start: str, end: str, cameras: Sequence[str], realtime: bool = False) -> DataFrame:
    daily = with_options(days(spans, start, end), camera=cameras)
    return daily.withColumn("folder", lasco_url(F.col("day"), F.col("camera"), realtime))


def spacecraft_folders(
    spans: DataFrame,
    start: str,
    end: str,
    datatypes: Sequence[str] = DATATYPES,
    spacecraft: Sequence[str] = SPACECRAFT,
    categories: Sequence[str] = CATEGORIES,
    instruments: Sequence[str] = SECCHI_INSTRUMENTS,
) -> DataFrame:
    daily = with_options(
        days(spans, start, end), datatype=datatypes, spacecraft=spacecraft, category=categories, instrument=instruments
    )
    url = secchi_url(*[F.col(c) for c in ("day", "datatype", "spacecraft", "category", "instrument")])
    return daily.withColumn("folder", url)


def uncovered_targets(
    targets: DataFrame, catalog: DataFrame, tolerance: timedelta, require_quality_zero: bool = True
) -> DataFrame:
    """(telescope, channel, time) still without an image in range."""
    held = good_quality(catalog, require_quality_zero)
    return covered(targets, held, ("telescope", "channel"), tolerance, inverted=True)


def manifest_files(found: DataFrame, include_spikes: bool = False) -> DataFrame:
    """Files found for the open targets; side files of the multi-channel imager are left out."""
    if include_spikes:
        return found
    return found.where(~((F.col("telescope") == "aia") & is_spike(F.col("filename"))))
