"""Instrument names, archive folders and remote locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sunloom.functions.times import base_name, date_in_file_name

# Fixed values.
FIRST_R_SATELLITE = 16
AIA_CHANNELS = ("193", "211", "171", "304", "94", "131", "335")
HMI_CHANNELS = ("m_45s", "m_720s")
CAMERAS = ("c1", "c2", "c3", "c4")
DATATYPES = ("science", "beacon")
SPACECRAFT = ("ahead", "behind")
CATEGORIES = ("img", "seq", "cal")
SECCHI_INSTRUMENTS = ("hi_1", "hi_2", "cor1", "cor2", "euvi")

# Public archive locations, by data set.
URL_TEMPLATES = {
    "omni_low_resolution": "https://spdf.gsfc.nasa.gov/pub/data/omni/low_res_omni/omni2_{year}.dat",
    "omni_high_resolution": "https://spdf.gsfc.nasa.gov/pub/data/omni/high_res_omni/omni_min{year}.asc",
    "omni_high_resolution_5min": "https://spdf.gsfc.nasa.gov/pub/data/omni/high_res_omni/omni_5min{year}.asc",
    "hpo": "https://kp.gfz.de/app/json/?start={year}-01-01T00:00:00Z&end={year}-12-31T23:59:59Z&index={index}",
    "goes_xrs_r": "https://data.ngdc.noaa.gov/platforms/solar-space-observing-satellites/goes/goes{NN}/l2/data/xrsf-l2-avg1m/{YYYY}/{MM}/",
    "goes_xrs_legacy": "https://www.ncei.noaa.gov/data/goes-space-environment-monitor/access/science/xrs/goes{NN}/xrsf-l2-avg1m_science/{YYYY}/{MM}/",
    "goes_mag_r": "https://data.ngdc.noaa.gov/platforms/solar-space-observing-satellites/goes/goes{NN}/l2/data/magn-l2-avg1m/{YYYY}/{MM}/",
    "goes_mag_legacy": "https://data.ngdc.noaa.gov/platforms/solar-space-observing-satellites/goes/goes{NN}/l2/data/magn-l2-avg1m/{YYYY}/{MM}/",
    "goes_proton_r": "https://data.ngdc.noaa.gov/platforms/solar-space-observing-satellites/goes/goes{NN}/l2/data/sgps-l2-avg1m/{YYYY}/{MM}/",
    "goes_proton_legacy": "https://data.ngdc.noaa.gov/platforms/solar-space-observing-satellites/goes/goes{NN}/l2/data/epead-science-proton-fluxes-l2-avg1m/{YYYY}/{MM}/",
    "lasco_archive": "https://lasco-www.nrl.navy.mil/lz/level_05/{yymmdd}/{camera}",
    "lasco_realtime": "https://umbra.nascom.nasa.gov/pub/lasco/lastimage/level_05/{yymmdd}/{camera}",
    "secchi_science": "https://stereo-ssc.nascom.nasa.gov/data/ins_data/secchi/L0/{letter}/{category}/{instrument}/{date}",
    "secchi_beacon": "https://stereo-ssc.nascom.nasa.gov/data/beacon/{spacecraft}/secchi/{category}/{instrument}/{date}",
}


def fill_template(template: str | Column, **parts: Column) -> Column:
    """Replace each ``{name}`` by its column."""
    filled = F.lit(template) if isinstance(template, str) else template
    for name, value in parts.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value.cast("string"))
    return filled


def split_instrument(instrument: Column) -> Column:
    """``aia_193`` or ``hmi_magnetogram`` to struct(telescope, channel)."""
    aia, hmi = instrument.startswith("aia_"), instrument.startswith("hmi_")
    rest = F.when(aia, F.replace(instrument, F.lit("aia_"), F.lit(""))).when(
        hmi, F.replace(instrument, F.lit("hmi_"), F.lit(""))
    )
    telescope = F.when(aia, "aia").when(hmi, "hmi").otherwise(instrument)
    channel = F.when(hmi & (rest == "magnetogram"), "m_45s").otherwise(F.coalesce(rest, F.lit("")))
    return F.struct(telescope.alias("telescope"), channel.alias("channel"))


def channel_wavelength(telescope: Column, channel: Column) -> Column:
    return F.when(telescope == "aia", F.trim(channel).try_cast("int"))


def is_r_series(satellite: Column) -> Column:
    return satellite >= FIRST_R_SATELLITE


def satellite_generation(satellite: Column) -> Column:
    return F.when(is_r_series(satellite), "r").otherwise("legacy")


def satellite_tag(satellite: Column) -> Column:
    return F.concat(F.lit("g"), two_digits(satellite))


def two_digits(number: Column) -> Column:
    return F.format_string("%02d", number)


def is_spike(name: Column) -> Column:
    """Despiking side files are not observations."""
    return F.lower(name).contains("spike")


def goes_url(instrument: str, satellite: Column, year: Column, month: Column) -> Column:
    pattern = F.when(is_r_series(satellite), URL_TEMPLATES[f"goes_{instrument}_r"]).otherwise(
        URL_TEMPLATES[f"goes_{instrument}_legacy"]
    )
    return fill_template(
        pattern, NN=two_digits(satellite), YYYY=F.format_string("%04d", year), MM=two_digits(month)
    )


def lasco_url(day: Column, camera: Column, realtime: bool = False) -> Column:
    template = URL_TEMPLATES["lasco_realtime" if realtime else "lasco_archive"]
    return fill_template(template, yymmdd=F.date_format(day, "yyMMdd"), camera=camera)


def secchi_url(day: Column, datatype: Column, spacecraft: Column, category: Column, instrument: Column) -> Column:
    template = F.when(datatype == "science", URL_TEMPLATES["secchi_science"]).otherwise(URL_TEMPLATES["secchi_beacon"])
    return fill_template(
        template,
        letter=F.substring(spacecraft, 1, 1),
        spacecraft=spacecraft,
        category=category,
        instrument=instrument,
        date=F.date_format(day, "yyyyMMdd"),
    )


def _dated_folder(ts: Column, *head: Column) -> Column:
    return F.concat_ws("/", *head, F.date_format(ts, "yyyy"), F.date_format(ts, "yyyyMMdd"))


def sdo_folder(root: Column, telescope: Column, ts: Column) -> Column:
    return _dated_folder(ts, root, telescope)


def lasco_folder(root: Column, camera: Column, ts: Column) -> Column:
    return _dated_folder(ts, root, camera)


def secchi_folder(root: Column, datatype: Column, spacecraft: Column, instrument: Column, ts: Column) -> Column:
    return _dated_folder(ts, root, datatype, spacecraft, instrument)


def goes_path(root: Column, satellite: Column, name: Column) -> Column:
    """Year 0000 collects names without a date."""
    year = F.coalesce(F.date_format(date_in_file_name(name), "yyyy"), F.lit("0000"))
    return F.concat_ws("/", root, satellite_tag(satellite), year, name)


def child(folder: Column, path: Column) -> Column:
    return F.concat_ws("/", folder, base_name(path))
