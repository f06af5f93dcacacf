"""Tumbling statistics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.functions.times import DAY, micros


# Doubles are summed as the decimals they are written as: those below 1e-3 with 28 digits
# behind the point, those below 1e20 with 18.
_FINE, _COARSE = "decimal(28,28)", "decimal(38,18)"


def _present(df: DataFrame, name: str) -> Column:
    """The value, with NaN as missing."""
    value = F.col(name)
    floating = isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType))
    return F.when(~F.isnan(value), value) if floating else value


def exact_sums(value: Column) -> dict[str, Column]:
    """Partial sums of a numeric column from which ``mean_of_sums`` takes its exact mean.

    Whole numbers and fractions of the decimals are added up apart, so that no sum leaves
    38 digits below 10^10 rows. Only values of 1e20 and more, infinities among them, are added
    as doubles. Sums of such sums are the sums of all rows.
    """
    x = value.cast("double")
    small = F.abs(x) < 1e-3
    coarse = F.when(~small, x).try_cast(_COARSE)
    whole = F.floor(coarse).cast("decimal(21,0)")
    return {
        "whole": F.sum(whole),
        "part": F.sum((coarse - whole).cast("decimal(19,18)")),
        "fine": F.sum(F.when(small, x).try_cast(_FINE)),
        "huge": F.sum(F.when(~small & coarse.isNull(), x)),
        "n": F.count(value),
    }


def mean_of_sums(sums: dict[str, Column]) -> Column:
    # Together where they fit, so that there is one rounding only.
    both = F.try_add(sums["whole"].try_cast(_COARSE), sums["part"].cast(_COARSE)).cast("double")
    parts = [
        F.coalesce(both, sums["whole"].cast("double") + sums["part"].cast("double")),
        sums["fine"].cast("double"),
        sums["huge"],
    ]
    total = sum((F.coalesce(p, F.lit(0.0)) for p in parts), F.lit(0.0))
    return F.try_divide(total, F.nullif(sums["n"].cast("double"), F.lit(0.0)))


def exact_mean(value: Column) -> Column:
    """The mean of a numeric column, the same for every order and partitioning of the rows."""
    return mean_of_sums(exact_sums(value))


def _bins(every: timedelta) -> Column:
    return F.window("datetime", f"{micros(every)} microseconds")


def present_values(df: DataFrame, variables: dict[str, Column], every: timedelta, by: Sequence[str] = ()) -> DataFrame:
    """Rows with a time, their variables without NaN; ``every`` must divide a day."""
    if DAY % micros(every):
        raise ValueError("the bin must divide a day")
    kept = df.select(*by, "datetime", *[v.alias(n) for n, v in variables.items()])
    kept = kept.where(F.col("datetime").isNotNull())
    return kept.select(*by, "datetime", *[_present(kept, n).alias(n) for n in variables])


def tumbling_stats(
    df: DataFrame,
    variables: dict[str, Column],
    every: timedelta,
    by: Sequence[str] = (),
) -> DataFrame:
    """``<name>_avg``, ``_min``, ``_max`` per bin, labelled by the bin's left edge.

    Bins are left-closed and aligned to midnight; missing values and NaN are skipped. The
    sums combine before the shuffle, so a crowded bin costs one row per task, and they
    are exact, hence the same for every partitioning.
    """
    kept = present_values(df, variables, every, by)
    statistics = []
    for name in variables:
        value = F.col(name)
        statistics += [
            exact_mean(value).alias(f"{name}_avg"),
            F.min(value).alias(f"{name}_min"),
            F.max(value).alias(f"{name}_max"),
        ]
    out = kept.groupBy(*by, _bins(every).alias("_bin")).agg(*statistics)
    named = [f"{n}_{s}" for n in variables for s in ("avg", "min", "max")]
    return out.select(*by, F.col("_bin.start").alias("datetime"), *named)


def partial_stats(df: DataFrame, variables: dict[str, Column], every: timedelta) -> DataFrame:
    """Per bin what ``merge_stats`` needs of these rows: ``datetime`` is the bin's left edge,
    ``latest`` its last time, ``rows`` its rows, then the sums and extremes of each variable.
    """
    kept = present_values(df, variables, every)
    parts = [F.max("datetime").alias("latest"), F.count("*").alias("rows")]
    for name in variables:
        value = F.col(name)
        kinds = {**exact_sums(value), "min": F.min(value), "max": F.max(value)}
        parts += [c.alias(f"{name}_{kind}") for kind, c in kinds.items()]
    out = kept.groupBy(_bins(every).alias("_bin")).agg(*parts)
    return out.select(F.col("_bin.start").alias("datetime"), *[c for c in out.columns if c != "_bin"])


def merge_partials(partials: DataFrame, variables: Sequence[str], counts: Sequence[str] = ("rows",)) -> DataFrame:
    """Partials of the same bins as one row a bin, again partials; exact in any order."""
    parts = [F.max("latest").alias("latest"), *[F.sum(c).alias(c) for c in counts]]
    for name in variables:
        parts += [F.sum(f"{name}_{kind}").alias(f"{name}_{kind}") for kind in ("whole", "part", "fine", "huge", "n")]
        parts += [F.min(f"{name}_min").alias(f"{name}_min"), F.max(f"{name}_max").alias(f"{name}_max")]
    merged = partials.groupBy("datetime").agg(*parts)
    kinds = {f.name: f.dataType for f in partials.schema}
    return merged.select(*[F.col(c).cast(kinds[c]).alias(c) for c in merged.columns])


def merge_stats(partials: DataFrame, variables: Sequence[str], counts: Sequence[str] = ("rows",)) -> DataFrame:
    """``tumbling_stats`` of all rows behind the partials, and their counts."""
    merged = merge_partials(partials, variables, counts)
    statistics = []
    for name in variables:
        sums = {kind: F.col(f"{name}_{kind}") for kind in ("whole", "part", "fine", "huge", "n")}
        statistics += [mean_of_sums(sums).alias(f"{name}_avg"), F.col(f"{name}_min"), F.col(f"{name}_max")]
    return merged.select("datetime", *statistics, *counts)


def align_to_grid(grid: DataFrame, stats: DataFrame) -> DataFrame:
    """Every grid time once; bins without data have NULL everywhere."""
    return grid.join(stats, "datetime", "left")
