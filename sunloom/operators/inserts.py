"""Which rows of a batch may enter a table: first wins, keys and unique columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sunloom.session import materialise

# Open rows of chains from which on rows are taken out before pointers are doubled.
DOUBLED_ROWS = 100_000


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key (NULLs equal); combined before the shuffle."""
    rest = [c for c in df.columns if c not in key and c not in order]
    ordered = [c for c in order if c not in key]
    winner = F.min(F.struct(*ordered, *rest)).alias("_row")
    firsts = df.groupBy(*key).agg(winner)
    return firsts.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


def without_known(df: DataFrame, known: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key the other frame lacks; NULL parts compare equal."""
    other = known.select(*[F.col(c).alias(f"_known_{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in key]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return df.join(other, condition, "left_anti")


def accept_in_order(df: DataFrame, key: Sequence[str], unique: str, ordinal: str) -> DataFrame:
    """Rows a row-by-row insert in ``ordinal`` order would take.

    A row is taken unless an earlier taken row has its key or its ``unique``
    value. Taking the first per key and then the first per value is wrong: a
    row beaten by a row that is itself refused must come back. So each round
    takes what is certain by now, drops what that excludes, and looks at the rest
    again; the same rounds for any size, and a handful is usual. A chain of rows, each
    barred by the one before alone, is settled inside a round, in steps that grow with
    the logarithm of its length. ``ordinal`` must be distinct.
    """
    keyed = df.select(*key, F.col(unique), F.col(ordinal))
    # Exact copies of a key and value pair can never be taken after their first.
    remaining = materialise(
        keyed.groupBy(*key, unique).agg(F.min(ordinal).alias(ordinal)), "open"
    )
    taken: DataFrame | None = None
    while not remaining.isEmpty():
        certain = _certain(remaining, key, unique, ordinal).withColumnRenamed("_row", ordinal)
        winners = materialise(remaining.join(certain, ordinal, "left_semi"), "taken")
        remaining = without_known(without_known(remaining, winners, key), winners, [unique])
        remaining = materialise(remaining, "open")
        winners = winners.select(ordinal)
        taken = winners if taken is None else taken.unionByName(winners)
    if taken is None:
        return df.limit(0)
    return df.join(taken, ordinal, "left_semi")


def _certain(rows: DataFrame, key: Sequence[str], unique: str, ordinal: str) -> DataFrame:
    """Rows (``_row``, their ordinal) taken for certain: those nothing bars, and each second
    row along the chains that start at one of them."""

    def places(by: Sequence[str], barred: str) -> DataFrame:
        # Of each group its first row, and of a pair also the second, barred by the first.
        # Other rows of larger groups wait for a later round.
        group = rows.groupBy(*by).agg(
            F.min(ordinal).alias("_a"), F.max(ordinal).alias("_b"), F.count("*").alias("_n")
        )
        first = F.struct(F.col("_a").alias("_row"), F.lit(None).cast(rows.schema[ordinal].dataType).alias(barred))
        second = F.struct(F.col("_b").alias("_row"), F.col("_a").alias(barred))
        return group.select(F.inline(F.when(F.col("_n") == 2, F.array(first, second)).otherwise(F.array(first))))

    both = places(key, "_by_key").join(places([unique], "_by_value"), "_row")
    n_bars = F.col("_by_key").isNotNull().cast("int") + F.col("_by_value").isNotNull().cast("int")
    seen = materialise(
        both.select("_row", F.coalesce("_by_key", "_by_value").alias("_bar"), n_bars.alias("_bars")), "places"
    )
    ends = seen.select(F.col("_row").alias("_bar"), F.col("_bars").alias("_before"))
    # A row with one bar has one follower at most, so no value of _bar is frequent below,
    # however long the chains: what lies at an end carries that and is not joined again.
    chains = materialise(
        seen.where("_bars = 1").join(ends, "_bar", "left").select(
            "_row",
            "_bar",
            F.lit(True).alias("_odd"),
            (F.coalesce("_before", F.lit(2)) != 1).alias("_ended"),
            (F.coalesce("_before", F.lit(2)) == 0).alias("_free"),
        ),
        "chains",
    )
    chains = _settled(chains)
    return seen.where("_bars = 0").select("_row").unionByName(chains.where("_free AND NOT _odd").select("_row"))


def _coin(column: str, level: int) -> Column:
    return F.xxhash64(column, F.lit(level)) % 2 == 0


def _settled(chains: DataFrame) -> DataFrame:
    """All rows of the chains at their ends.

    Doubling moves every row for each power of two of the length. So while rows are many,
    a quarter by hash, no two in succession, are taken out of the chains; these find their
    end last, from the row that bars them. All levels together are a few times the rows.
    """
    ended, open_rows = chains.where("_ended"), chains.where("NOT _ended")
    levels: list[DataFrame] = []
    while open_rows.count() > DOUBLED_ROWS:
        level = len(levels)
        goes = _coin("_row", level) & ~_coin("_bar", level)
        out, stays = open_rows.where(goes), open_rows.where(~goes)
        ahead = out.select(F.col("_row").alias("_bar"), F.col("_bar").alias("_to"), F.col("_odd").alias("_more"))
        moved = stays.where(_coin("_bar", level)).join(ahead, "_bar", "left").select(
            "_row",
            F.coalesce("_to", "_bar").alias("_bar"),
            (F.col("_odd") != F.coalesce("_more", F.lit(False))).alias("_odd"),
            "_ended",
            "_free",
        )
        open_rows = materialise(stays.where(~_coin("_bar", level)).unionByName(moved), "chains")
        levels.append(out)
    chains = ended.unionByName(open_rows) if levels else chains
    while not chains.where("NOT _ended").isEmpty():
        chains = materialise(_further(_further(chains)), "chains")
    for level in reversed(range(len(levels))):
        known = chains.where(~_coin("_row", level)).select(
            F.col("_row").alias("_bar"), F.col("_odd").alias("_more"), F.col("_free").alias("_sure")
        )
        found = levels[level].join(known, "_bar").select(
            "_row",
            "_bar",
            (F.col("_odd") != F.col("_more")).alias("_odd"),
            F.lit(True).alias("_ended"),
            F.col("_sure").alias("_free"),
        )
        chains = chains.unionByName(materialise(found, "chains"))
    return chains


def _further(chains: DataFrame) -> DataFrame:
    """Each row's pointer doubled: from the row that bars it to where that one points."""
    ahead = chains.select(
        F.col("_row").alias("_bar"),
        F.col("_bar").alias("_to"),
        F.col("_odd").alias("_more"),
        F.col("_ended").alias("_end"),
        F.col("_free").alias("_sure"),
    )
    moved = chains.where("NOT _ended").join(ahead, "_bar").select(
        "_row",
        F.col("_to").alias("_bar"),
        (F.col("_odd") != F.col("_more")).alias("_odd"),
        F.col("_end").alias("_ended"),
        F.col("_sure").alias("_free"),
    )
    return chains.where("_ended").unionByName(moved)
