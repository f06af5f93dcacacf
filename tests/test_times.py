from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sunloom.functions import times


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("08/12/95 01:02:03", datetime(1995, 12, 8, 1, 2, 3)),
        ("08/12/68", datetime(2068, 12, 8)),
        ("8/12/1995 1:2:3.5", datetime(1995, 12, 8, 1, 2, 3, 500000)),
        ("2024-1-2 3:4:5", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01- 5", datetime(2024, 1, 5)),
        ("2024-01-02T03:04:05.123456ZZ", datetime(2024, 1, 2, 3, 4, 5, 123456)),
        ("2024/01/02T03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024.01.01_00:00:37_TAI", datetime(2024, 1, 1, 0, 0, 37)),
        ("2024.01.01_00:00:37.5_TAI", datetime(2024, 1, 1, 0, 0, 37, 500000)),
        ("2024.01.01_00:00:37", None),
        ("2024-02-30", None),
        ("2024-01-02 24:00:00", None),
        ("2024-01-02 00:00:60", None),
        ("2024-01-02 00:00:00Z", None),
        ("2024-01/02", None),
        ("2024-01-02 03:04", None),
        ("2024", None),
        ("0000-01-01", None),
        ("", None),
    ],
)
def test_parse_datetime(spark, text, expected):
    assert _one(spark, times.parse_datetime(F.lit(text))) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024.01.01_00:00:37", datetime(2024, 1, 1, 0, 0, 37)),
        ("2024.01.01_00:00:37.25_TAI", datetime(2024, 1, 1, 0, 0, 37, 250000)),
        ("2024-01-01T00:00:00.000Z", datetime(2024, 1, 1)),
        ("2024-01-01 00:00:00", None),
        (" 2024-01-01T00:00:00", None),
    ],
)
def test_parse_record_time(spark, text, expected):
    assert _one(spark, times.parse_record_time(F.lit(text))) == expected


def test_file_name_falls_back_to_second_form(spark):
    name = "x/aia.2010-13-01T000008Z.20100901_000000_TAI.fits"
    assert _one(spark, times.time_in_file_name(F.lit(name))) == datetime(2010, 9, 1)


def test_tai_shift_only_for_hmi(spark):
    at = times.ntz("2024-01-01 00:00:37")
    assert _one(spark, times.tai_to_utc(at, F.lit("hmi"))) == datetime(2024, 1, 1)
    assert _one(spark, times.tai_to_utc(at, F.lit("aia"))) == datetime(2024, 1, 1, 0, 0, 37)
    assert _one(spark, times.utc_to_tai(at, F.lit("hmi"))) == datetime(2024, 1, 1, 0, 1, 14)


def test_day_of_year(spark):
    made = times.day_of_year_timestamp(F.lit(2024.0), F.lit(60.0), F.lit(1.0), F.lit(30.0))
    assert _one(spark, made) == datetime(2024, 2, 29, 1, 30)
    assert _one(spark, times.day_of_year_timestamp(F.lit(2024.0), F.lit(None).cast("double"), F.lit(1.0))) is None


def test_fractional_hour(spark):
    made = times.fractional_hour_timestamp(F.lit(2024.0), F.lit(1.0), F.lit(1.0), F.lit(23.5))
    assert _one(spark, made) == datetime(2024, 1, 1, 23, 30)
    assert _one(spark, times.fractional_hour_timestamp(F.lit(2024.0), F.lit(2.0), F.lit(30.0), F.lit(0.0))) is None
    assert _one(spark, times.fractional_hour_timestamp(F.lit(2024.0), F.lit(1.0), F.lit(1.0), F.lit(3.9999))) is None


@pytest.mark.parametrize("stamp", ["1969-12-31 23:59:59.999999", "2024-02-29 12:34:56.000001", "1900-01-01 00:00:00"])
def test_micros_round_trip(spark, stamp):
    at = times.ntz(stamp)
    assert _one(spark, times.from_micros(times.epoch_micros(at))) == datetime.fromisoformat(stamp)


def test_micros_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert _one(spark, times.epoch_micros(times.ntz("2024-03-10 02:30:00"))) == 1710037800000000
        assert _one(spark, times.from_micros(F.lit(1710037800000000))) == datetime(2024, 3, 10, 2, 30)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "minute, expected", [("00:30", 1), ("00:29", 0), ("03:29", 3), ("23:30", 0)]
)
def test_round_hour(spark, minute, expected):
    assert _one(spark, times.round_hour(times.ntz(f"2024-01-01 {minute}:00"))).hour == expected


def test_decode_time_axis(spark):
    values = F.array(F.lit(0.0), F.lit(1.5))
    decoded = _one(spark, times.decode_time_axis(values, F.lit("hours since 2000-01-01 12:00:00 UTC")))
    assert decoded == [datetime(2000, 1, 1, 12), datetime(2000, 1, 1, 13, 30)]
    assert _one(spark, times.decode_time_axis(values, F.lit("furlongs"))) is None
