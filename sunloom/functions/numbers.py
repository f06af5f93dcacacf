"""Numbers from text, missing values, storage casts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def to_number(text: Column) -> Column:
    """Double, or NULL for text that is not a plain decimal number.

    ``text`` is referenced several times: name it in a projection before. The cast
    alone would also take ``12.5f``, ``NaN`` and hexadecimal numbers.
    """
    plain = F.right(text, F.lit(1)).between(".", "9") & ~text.contains("x") & ~text.contains("X")
    return F.when(plain, text.try_cast("double"))


def bare_text(text: Column) -> Column:
    return F.btrim(text, F.lit(" \t\r"))


def drop_sentinels(value: Column, sentinels: Sequence[float]) -> Column:
    """NULL where the double equals one of the fill values."""
    if not sentinels:
        return value
    return F.when(~value.isin([float(s) for s in sentinels]), value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column."""
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.col(name).isNull() | F.isnan(name)
    return F.col(name).isNull()


def any_missing(df: DataFrame, names: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_missing(df, n) for n in names], F.lit(False))


def storage_cast(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast to the declared type; fractions round half to even, misfits become NULL."""
    if source == target:
        return value
    if isinstance(target, T.IntegralType) and isinstance(source, T.FractionalType):
        value = F.rint(value)
    return value.try_cast(target)
