"""Timestamps: parsing, shifting, rounding.

Everything is ``timestamp_ntz`` in UTC. The helpers use only date and clock
fields, so the session time zone never enters.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND = 1_000_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# Fixed value.
TAI_OFFSET_SECONDS = 37


def micros(step: timedelta) -> int:
    return step // timedelta(microseconds=1)


def ntz(value: datetime | date | str) -> Column:
    """Literal timestamp without zone."""
    return F.lit(str(value)).cast("timestamp_ntz")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01 of the wall clock."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    clock = (F.hour(ts).cast("bigint") * 60 + F.minute(ts)) * MINUTE
    second = F.extract(F.lit("SECOND"), ts) * F.lit(SECOND)
    return days * DAY + clock + second.cast("bigint")


def from_micros(value: Column) -> Column:
    return plus_micros(ntz("1970-01-01"), value)


def plus_micros(ts: Column, value: Column | int) -> Column:
    value = F.lit(value) if isinstance(value, int) else value
    zero = F.lit(0)
    seconds = (value.cast("decimal(18,0)") / F.lit(SECOND).cast("decimal(7,0)")).cast("decimal(18,6)")
    return ts + F.make_dt_interval(zero, zero, zero, seconds)


def floor_time(ts: Column, step: int) -> Column:
    """Start of the ``step``-microsecond bin, bins aligned to midnight."""
    since = epoch_micros(ts)
    return from_micros(since - F.pmod(since, F.lit(step)))


def round_hour(ts: Column) -> Column:
    """Nearest hour; minute 30 and later go up."""
    return floor_time(plus_micros(ts, 30 * MINUTE), HOUR)


def day_of_year_timestamp(year: Column, day: Column, hour: Column, minute: Column | None = None) -> Column:
    """Year, day of year and clock; NULL if a part is missing."""
    zero = F.lit(0)
    first = F.try_make_timestamp_ntz(year.try_cast("int"), F.lit(1), F.lit(1), zero, zero, F.lit(0).cast("decimal(8,6)"))
    minute = zero if minute is None else minute.try_cast("int")
    return first + F.make_dt_interval(day.try_cast("int") - 1, hour.try_cast("int"), minute)


def fractional_hour_timestamp(year: Column, month: Column, day: Column, hour: Column) -> Column:
    """Calendar day and hour with a fraction; minutes rounded half to even."""
    whole = F.floor(hour)
    return F.try_make_timestamp_ntz(
        year.try_cast("int"),
        month.try_cast("int"),
        day.try_cast("int"),
        whole.try_cast("int"),
        F.rint((hour - whole) * 60).try_cast("int"),
        F.lit(0).cast("decimal(8,6)"),
    )


def fractional_hour(ts: Column) -> Column:
    return F.hour(ts) + F.minute(ts) / F.lit(60.0)


_TIME = r"\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6})?"
_YEAR = r"(?!0000)(\d{4})"
_DAY = r"(?: (?=[1-9](?:\D|$)))?(\d{1,2})"

# Pattern of a whole text, and how to say it in year-month-day order.
_YEAR_FIRST = (rf"^{_YEAR}([-/])(\d{{1,2}})\2{_DAY}(?:(?:T|\s+)({_TIME}))?$", "$1-$3-$4 $5")
_YEAR_LAST = (rf"^(\d{{1,2}})/(\d{{1,2}})/{_YEAR}(?:\s+({_TIME}))?$", "$3-$2-$1 $4")
_SHORT_YEAR_19 = (rf"^(\d{{1,2}})/(\d{{1,2}})/(69|[7-9]\d)(?:\s+({_TIME}))?$", "19$3-$2-$1 $4")
_SHORT_YEAR_20 = (rf"^(\d{{1,2}})/(\d{{1,2}})/([0-5]\d|6[0-8])(?:\s+({_TIME}))?$", "20$3-$2-$1 $4")
_DOTTED = (rf"^{_YEAR}\.(\d{{1,2}})\.{_DAY}_({_TIME})$", "$1-$2-$3 $4")
_ISO_T = (rf"^{_YEAR}-(\d{{1,2}})-{_DAY}T({_TIME})$", "$1-$2-$3 $4")


def _read(text: Column, form: tuple[str, str]) -> Column:
    """Timestamp of a text in one form, else NULL; ``text`` is referenced once."""
    pattern, plain = form
    return F.regexp_replace(F.regexp_substr(text, F.lit(pattern)), pattern, plain).try_cast("timestamp_ntz")


def parse_tai(text: Column) -> Column:
    """``2024.01.01_00:00:37_TAI``, with or without a fraction; no offset applied."""
    return F.when(text.contains("_TAI"), _read(F.replace(text, F.lit("_TAI"), F.lit("")), _DOTTED))


def parse_datetime(text: Column) -> Column:
    """Any observation time written in an image header.

    TAI text, ISO with ``T`` (closing ``Z`` dropped), ``-`` or ``/`` dates with a
    blank before the clock, day-first dates with two (69-99 are 19xx) or four year
    digits, and dates alone. Days, months and clocks need no leading zero.
    """
    bare = F.btrim(text, F.lit(" \t\r\n"))
    plain = F.when(bare.contains("T"), F.rtrim(bare, F.lit("Z"))).otherwise(bare)
    return F.coalesce(
        parse_tai(bare),
        *[_read(plain, form) for form in (_YEAR_FIRST, _SHORT_YEAR_19, _SHORT_YEAR_20, _YEAR_LAST)],
    )


def parse_record_time(text: Column) -> Column:
    """Record time of the solar-disc imagers: TAI, ISO with ``T`` or dotted text."""
    iso = F.when(text.contains("T"), _read(F.replace(text, F.lit("Z"), F.lit("")), _ISO_T))
    return F.coalesce(parse_tai(text), iso, _read(text, _DOTTED))


def time_in_file_name(path: Column) -> Column:
    """``2010-09-01T000008Z`` or ``20100901_000000_TAI`` anywhere in the base name."""
    name = base_name(path)
    iso = F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2}T\d{2}\d{2}\d{2})Z", 1)
    tai = F.regexp_extract(name, r"(\d{8}_\d{6})_TAI", 1)
    spread_iso = F.regexp_replace(iso, r"^(.{13})(..)(..)$", "$1:$2:$3")
    spread_tai = F.regexp_replace(tai, r"^(....)(..)(..)_(..)(..)(..)$", "$1-$2-$3T$4:$5:$6")
    return F.coalesce(_read(spread_iso, _ISO_T), _read(spread_tai, _ISO_T))


def date_in_file_name(name: Column) -> Column:
    """Date of ``_dYYYYMMDD_``, NULL if absent or not a calendar day."""
    digits = F.regexp_extract(name, r"_d(\d{8})_", 1)
    spread = F.regexp_replace(digits, r"^(....)(..)(..)$", "$1-$2-$3")
    return F.when(F.substring(digits, 1, 4) != "0000", spread.try_cast("date"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def tai_to_utc(ts: Column, telescope: Column, seconds: int = TAI_OFFSET_SECONDS) -> Column:
    """Only the magnetic imager records TAI; other telescopes pass unchanged."""
    return F.when(telescope == "hmi", plus_micros(ts, -seconds * SECOND)).otherwise(ts)


def utc_to_tai(ts: Column, telescope: Column, seconds: int = TAI_OFFSET_SECONDS) -> Column:
    return tai_to_utc(ts, telescope, -seconds)


# Microseconds per unit of a "<unit> since <epoch>" time axis.
TIME_UNITS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": SECOND,
    "sec": SECOND,
    "s": SECOND,
    "minute": MINUTE,
    "min": MINUTE,
    "hour": HOUR,
    "hr": HOUR,
    "h": HOUR,
    "day": DAY,
    "d": DAY,
}


def decode_time_axis(values: Column, units: Column) -> Column:
    """Array of timestamps from numbers counted in ``units`` (standard calendar)."""
    pattern = r"^\s*([A-Za-z]+?)s?\s+since\s+(.*?)\s*(?:UTC|Z)?\s*$"
    unit = F.lower(F.regexp_extract(units, pattern, 1))
    unit = F.when(unit == "", F.lit("s")).otherwise(unit)
    epoch = parse_datetime(F.regexp_extract(units, pattern, 2))
    size = F.create_map(*[F.lit(x) for pair in TIME_UNITS.items() for x in pair])[unit]
    return F.when(
        epoch.isNotNull() & size.isNotNull(),
        F.transform(values, lambda v: plus_micros(epoch, F.rint(v * size).cast("bigint"))),
    )
