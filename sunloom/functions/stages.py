"""Keeping costly expressions from being evaluated more than once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that a later filter reads instead of evaluating again.

    Filters are pushed below projections by repeating their expressions, which
    for a parsed record means parsing it again for every column in the condition.
    They stop at a generator, here one that yields exactly one row.
    """
    one = F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))
    return df.select("*", F.inline(one))
