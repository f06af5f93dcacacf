"""Row positions and moving windows over one long series."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from sunloom.session import materialise


def with_row_index(df: DataFrame, *order: str, name: str = "row_index") -> DataFrame:
    """Dense position of each row in the global order, from 0.

    The rows are range-partitioned and sorted once, written to the shared folder
    with their place in the partition, and shifted by the size of the partitions
    before. Only one number per partition meets in a single task, so this holds
    for any key distribution as long as ``order`` tells rows apart.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranged.withColumn("_part", F.spark_partition_id()).withColumn(
        "_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    )
    stored = materialise(placed, "row-index")
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    # One row per partition of the sort: bounded by the partition count.
    joined = stored.join(F.broadcast(offsets), "_part")
    return joined.withColumn(name, F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")


def with_running_totals(df: DataFrame, order: Sequence[str], totals: dict[str, str]) -> DataFrame:
    """Totals of whole-number columns from the first row, in the order, to each row.

    ``totals`` maps a new name to a column. Rows are range-partitioned and sorted once;
    a partition adds up its own rows, and one row of sums per partition gives what lies
    before it. ``order`` must tell rows apart.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    stored = materialise(ranged, "running")
    sums = stored.groupBy("_part").agg(*[F.sum(c).alias(n) for n, c in totals.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in totals])
    so_far = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = stored.select("*", *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(n) for n, c in totals.items()])
    # One row per partition of the sort: bounded by the partition count.
    joined = running.join(F.broadcast(offsets), "_part")
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_before_{n}")).alias(n) for n in totals])


def moving_window(
    df: DataFrame,
    before: int,
    after: int,
    measures: dict[str, tuple[Column, int, int]],
    index: str = "row_index",
    block: int | None = None,
) -> DataFrame:
    """Aggregates over row frames of a dense index, without one global window.

    ``measures`` maps a name to (aggregate, first offset, last offset), offsets
    within ``-before .. after - 1``. Rows are cut into blocks of equal length;
    every row also visits the neighbour blocks whose frames reach it, and keeps
    its result from its home block only.
    """
    spread = _in_blocks(df, before, after, index, block)
    ordered = Window.partitionBy("_block").orderBy(index)
    columns = [agg.over(ordered.rowsBetween(lo, hi)).alias(name) for name, (agg, lo, hi) in measures.items()]
    return spread.select("*", *columns).where(F.col("_home") == F.col("_block")).drop("_home", "_block")


def _in_blocks(df: DataFrame, before: int, after: int, index: str, block: int | None) -> DataFrame:
    """Each row once for every block whose frames reach it, with ``_block`` and ``_home``."""
    reach = max(before + after, 1)
    length = block or max(8 * reach, 4096)
    if length < reach:
        raise ValueError("a block must be at least as long as the frame")
    row = F.col(index)
    home = F.floor(row / length).cast("bigint")
    lowest = F.floor((row - (after - 1)) / length).cast("bigint")
    highest = F.floor((row + before) / length).cast("bigint")
    return df.withColumn("_home", home).withColumn("_block", F.explode(F.sequence(lowest, highest)))


@dataclass(frozen=True)
class Frame:
    """A moving ``sum`` of whole numbers, ``max`` or ``min`` of a column, or its ``value`` at ``first``.

    ``first`` and ``last`` are offsets from the row, both included.
    """

    kind: str
    column: str
    first: int
    last: int

    @property
    def width(self) -> int:
        return self.last - self.first + 1


def _at(column: Column, offset: int, ordered: WindowSpec) -> Column:
    return F.lead(column, offset).over(ordered) if offset >= 0 else F.lag(column, -offset).over(ordered)


def moving_frames(
    df: DataFrame, frames: dict[str, Frame], index: str = "row_index", block: int | None = None
) -> DataFrame:
    """Moving sums and extremes over a dense index, in time that does not depend on the width.

    Spark folds the frame anew for each row of a sliding extreme. Here the rows are cut
    into pieces as long as the frame, so a frame is the end of one piece and the start of
    the next: its extreme is the better of a running extreme from the row to the end of its
    piece and one from the start of the next piece on. Sums are differences of a running
    sum. Both are read at a fixed distance, and nothing is folded twice.

    Frames are clipped at the ends of the series; nulls are skipped, and a frame without
    values is null. Results are kept in each row's home block only.
    """
    before = max([0] + [-f.first for f in frames.values()])
    after = max([0] + [f.last for f in frames.values()]) + 1
    # Pieces lie inside blocks, so one shuffle by block serves all windows.
    rows = _in_blocks(df, before, after, index, block).repartition("_block")
    at = F.col(index)
    helpers: dict[tuple, str] = {}
    for width in sorted({f.width for f in frames.values() if f.kind in ("max", "min")}):
        rows = rows.withColumn("_piece", F.floor(at / width).cast("bigint"))
        pieces = Window.partitionBy("_block", "_piece")
        wanted = sorted({(f.kind, f.column) for f in frames.values() if f.width == width and f.kind in ("max", "min")})
        running = []
        for way, order in (("up", at.asc()), ("down", at.desc())):
            over = pieces.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
            for kind, column in wanted:
                name = f"_{way}{len(helpers)}"
                helpers[way, kind, column, width] = name
                running.append((F.max if kind == "max" else F.min)(column).over(over).alias(name))
        rows = rows.select("*", *running).drop("_piece")
    ordered = Window.partitionBy("_block").orderBy(index)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = {c: f"_total{k}" for k, c in enumerate(sorted({f.column for f in frames.values() if f.kind == "sum"}))}
    for column, name in totals.items():
        given = F.coalesce(F.col(column).cast("bigint"), F.lit(0))
        rows = rows.select(
            "*",
            F.sum(given).over(so_far).alias(name),
            F.count(column).over(so_far).alias(f"{name}n"),
        )
    rows = rows.select("*", F.first(index).over(whole).alias("_begin"), F.last(index).over(whole).alias("_end"))
    ends = sorted({*totals.values(), *(f"{t}n" for t in totals.values()), *(h for k, h in helpers.items() if k[0] == "up")})
    begins = sorted(h for k, h in helpers.items() if k[0] == "down")
    rows = rows.select(
        "*",
        *[F.last(c).over(whole).alias(f"{c}_end") for c in ends],
        *[F.first(c).over(whole).alias(f"{c}_begin") for c in begins],
    )

    def since(name: str, f: Frame) -> Column:
        """A running value at the frame's first row, or at the series' first one."""
        short = at + f.first < F.col("_begin")
        return F.when(short, F.col(f"{name}_begin")).otherwise(_at(F.col(name), f.first, ordered))

    def until(name: str, f: Frame) -> Column:
        """A running value at the frame's last row, or at the series' last one."""
        past = at + f.last > F.col("_end")
        return F.when(past, F.col(f"{name}_end")).otherwise(_at(F.col(name), f.last, ordered))

    results = []
    for name, f in frames.items():
        there = (at + f.first <= F.col("_end")) & (at + f.last >= F.col("_begin"))
        if f.kind == "value":
            value = _at(F.col(f.column), f.first, ordered)
        elif f.kind == "sum":
            total = totals[f.column]
            sums = [until(t, f) - F.coalesce(_at(F.col(t), f.first - 1, ordered), F.lit(0)) for t in (total, f"{total}n")]
            value = F.when(there & (sums[1] > 0), sums[0])
        else:
            start = since(helpers["down", f.kind, f.column, f.width], f)
            end = until(helpers["up", f.kind, f.column, f.width], f)
            past = at + f.last > F.col("_end")
            pieces = [
                F.floor(row / f.width)
                for row in (F.greatest(at + f.first, F.col("_begin")), F.least(at + f.last, F.col("_end")))
            ]
            both = (F.greatest if f.kind == "max" else F.least)(start, end)
            # A frame inside one piece is clipped, or the piece itself: one side has it all.
            value = F.when(there, F.when(pieces[0] < pieces[1], both).when(past, start).otherwise(end))
        results.append(value.alias(name))
    kept = [c for c in (*df.columns, "_home", "_block")]
    return rows.select(*kept, *results).where(F.col("_home") == F.col("_block")).drop("_home", "_block")
