"""Expressions over arrays and maps decoded from instrument files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_existing(variables: Column, names: Sequence[str]) -> Column:
    """Entry of the first name the map holds, even if that entry has no values."""
    picked = F.when(F.lit(False), variables[names[0]])
    for name in names:
        picked = picked.when(F.map_contains_key(variables, name), variables[name])
    return picked


def nulls_for_nans(values: Column) -> Column:
    return F.transform(values, lambda v: F.when(~F.isnan(v), v))


def vector_length(*components: Column) -> Column:
    total = None
    for c in components:
        total = c * c if total is None else total + c * c
    return F.sqrt(total)


def mean_over_sensors(data: Column, sensors: Column, channels: Column, first: Column) -> Column:
    """Mean per channel of a (sensor, channel) block of flat values, missing ones skipped.

    The block starts at position ``first`` of ``data``, which should be a plain
    column: it is read once per value.
    """

    def channel_mean(c: Column) -> Column:
        values = F.transform(
            F.sequence(F.lit(0), sensors - 1), lambda s: F.get(data, first + s * channels + c)
        )
        seen = F.filter(values, lambda v: v.isNotNull())
        counted = F.aggregate(
            seen,
            F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
            lambda acc, v: F.struct((acc["total"] + v).alias("total"), (acc["n"] + 1).alias("n")),
            lambda acc: F.try_divide(acc["total"], acc["n"]),
        )
        return counted

    return F.transform(F.sequence(F.lit(0), channels - 1), channel_mean)


def integral_flux(flux: Column, lower_kev: Column, upper_kev: Column, threshold_mev: float) -> Column:
    """Flux above a threshold: each channel counts with its width above it.

    NULL if every channel value is missing or the widths add up to nothing. A
    channel with a missing bound drops out without making the result NULL.
    """
    threshold = F.lit(float(threshold_mev) * 1000.0)

    def width(low: Column, high: Column) -> Column:
        known = low.isNotNull() & high.isNotNull()
        return F.when(known, F.greatest(F.lit(0.0), high - F.greatest(threshold, low)))

    widths = F.zip_with(lower_kev, upper_kev, width)
    terms = F.zip_with(flux, widths, lambda x, w: F.coalesce(x * w, F.lit(0.0)))
    total = F.aggregate(terms, F.lit(0.0), lambda acc, v: acc + v)
    reaches = F.exists(widths, lambda w: w.isNull() | (w > 0))
    observed = F.exists(flux, lambda v: v.isNotNull())
    return F.when(F.coalesce(reaches, F.lit(False)) & F.coalesce(observed, F.lit(False)), total)
