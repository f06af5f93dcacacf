"""Matches in time: nearest record, existence within a tolerance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunloom.functions.times import epoch_micros, from_micros, micros


def nearest_record(
    records: DataFrame,
    target: Column,
    tolerance: timedelta,
    order: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """The record closest to one time, within the tolerance; at most one row."""
    span = micros(tolerance)
    held = records if where is None else records.where(where)
    near = held.where(
        (F.col("datetime") >= target - F.expr(f"INTERVAL '{span / 1e6:.6f}' SECOND"))
        & (F.col("datetime") <= target + F.expr(f"INTERVAL '{span / 1e6:.6f}' SECOND"))
    )
    gap = F.abs(epoch_micros(F.col("datetime")) - epoch_micros(target))
    return near.withColumn("gap_us", gap).orderBy("gap_us", "datetime", *order).limit(1)


def nearest_matches(
    targets: DataFrame,
    records: DataFrame,
    dims: Sequence[str],
    tolerance: timedelta,
    order: Sequence[str],
    target_time: str = "target_time",
    slots: int = 1024,
    how: str = "inner",
) -> DataFrame:
    """For each target the record nearest in time with the same ``dims``.

    On equal gaps the earlier record wins, then the lower ``order`` columns. All
    other columns of the record are added; ``how='left'`` keeps unmatched targets.

    Only time and ``order`` take part in the match; the other columns are fetched by one
    join with what was matched. Of records equal in all these the least stands.

    No pairs are formed. Records of one time collapse to one, as do targets of one
    time. Time is cut into blocks a tolerance long and these into ``slots``; inside
    a slot two running windows read off the last record before and the first one
    after a target. What lies outside the slot comes from the slots' outermost
    records, by a window over the slots of a block and its two neighbours. So no
    group grows with the data: a slot holds at most one record per microsecond
    (under two million for half an hour and 1024 slots), a block three times
    ``slots`` rows.
    """
    span = micros(tolerance)
    slot_size = max(-(-span // slots), 1)
    payload = [c for c in records.columns if c not in dims]
    rest = [c for c in payload if c not in ("datetime", *order)]

    at = epoch_micros(F.col("datetime"))
    keyed = records.where(F.col("datetime").isNotNull()).select(
        *dims, at.alias("_us"), F.struct(*order).alias("_rec")
    )
    slot = F.floor(F.col("_us") / F.lit(slot_size)).cast("bigint").alias("_slot")
    single = keyed.groupBy(*dims, "_us").agg(F.min("_rec").alias("_rec")).select(*dims, slot, "_us", "_rec")
    # Copies of a target time meet once; they fan out again in the last join.
    wanted = targets.select(*dims, epoch_micros(F.col(target_time)).alias("_us")).distinct().select(*dims, slot, "_us")

    point = F.struct("_us", "_rec")
    both = single.select(*dims, "_slot", point.alias("_point"), F.lit(0).alias("_asked")).unionByName(
        wanted.select(*dims, "_slot", F.lit(1).alias("_asked")), allowMissingColumns=True
    )
    edges = both.groupBy(*dims, "_slot").agg(
        F.min("_point").alias("_first"), F.max("_point").alias("_last"), F.max("_asked").alias("_asked")
    )
    home = F.floor(F.col("_slot") / F.lit(slots)).cast("bigint")
    visited = F.when(F.col("_first").isNotNull(), F.sequence(home - 1, home + 1)).otherwise(F.array(home))
    visiting = edges.withColumn("_home", home).withColumn("_block", F.explode(visited))
    blocks = Window.partitionBy(*dims, "_block")
    earlier = blocks.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    later = blocks.orderBy(F.desc("_slot")).rowsBetween(Window.unboundedPreceding, -1)
    reached = visiting.select(
        "*",
        F.last("_last", ignorenulls=True).over(earlier).alias("_before"),
        F.last("_first", ignorenulls=True).over(later).alias("_after"),
    ).where((F.col("_home") == F.col("_block")) & (F.col("_asked") == 1))
    carried = reached.select(*dims, "_slot", F.explode(F.array("_before", "_after")).alias("_edge"))
    carried = carried.where(F.col("_edge").isNotNull())

    mixed = wanted.unionByName(single, allowMissingColumns=True).unionByName(
        carried.select(*dims, "_slot", F.col("_edge._us").alias("_us"), F.col("_edge._rec").alias("_rec"))
    )
    seen = F.when(F.col("_rec").isNotNull(), point)
    groups = Window.partitionBy(*dims, "_slot")
    is_target = F.col("_rec").isNull().cast("int")
    back = groups.orderBy("_us", is_target).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = groups.orderBy(F.desc("_us"), is_target).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = mixed.select(
        "*",
        F.last(seen, ignorenulls=True).over(back).alias("_prev"),
        F.last(seen, ignorenulls=True).over(ahead).alias("_next"),
    ).where(F.col("_rec").isNull())

    gap_prev = F.col("_us") - F.col("_prev._us")
    gap_next = F.col("_next._us") - F.col("_us")
    prev_ok, next_ok = gap_prev <= span, gap_next <= span
    take_prev = prev_ok & (~F.coalesce(next_ok, F.lit(False)) | (gap_prev <= gap_next))
    best = F.when(take_prev, F.col("_prev")).when(next_ok, F.col("_next"))
    matched = scanned.select(*dims, "_us", best.alias("_best")).where(F.col("_best").isNotNull())
    found = F.col("_best._us")
    matched = matched.select(
        *dims,
        "_us",
        found.alias("_found"),
        *[F.col(f"_best._rec.{c}").alias(c) for c in order],
    )
    if rest:
        matched = _with_payload(matched, records, dims, order, rest)
    named = matched.select(
        *dims, "_us", from_micros(F.col("_found")).alias("datetime"),
        F.abs(F.col("_found") - F.col("_us")).alias("gap_us"), *order, *rest,
    )
    keyed_targets = targets.withColumn("_us", epoch_micros(F.col(target_time)))
    out = keyed_targets.join(named, [*dims, "_us"], how)
    return out.select(*targets.columns, "datetime", "gap_us", *order, *rest)


def _with_payload(
    matched: DataFrame, records: DataFrame, dims: Sequence[str], order: Sequence[str], rest: Sequence[str]
) -> DataFrame:
    """The matches with the ``rest`` of their record, which key, time and order find again."""
    keys = [*dims, "_found", *order]
    asked = matched.select(*[F.col(c).alias(f"_of_{c}") for c in keys]).distinct()
    timed = records.withColumn("_found", epoch_micros(F.col("datetime")))
    same = F.lit(True)
    for c in keys:
        # Keys and times are there on both sides; an order column may be missing.
        same = same & (F.col(c).eqNullSafe(F.col(f"_of_{c}")) if c in order else F.col(c) == F.col(f"_of_{c}"))
    held = timed.join(asked, same, "left_semi").groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_rest"))
    named = held.select(*[F.col(c).alias(f"_of_{c}") for c in keys], *[F.col(f"_rest.{c}").alias(c) for c in rest])
    return matched.join(named, same).select(*matched.columns, *rest)


def covered(
    targets: DataFrame,
    records: DataFrame,
    dims: Sequence[str],
    tolerance: timedelta,
    target_time: str = "target_time",
    inverted: bool = False,
) -> DataFrame:
    """Targets with (or, ``inverted``, without) any record within the tolerance.

    Time is cut into slots one tolerance long. A record in a target's own slot is near
    enough; otherwise only the last one of the slot before or the first one of the slot
    after can be. So the records shrink to their first and last time in each slot, and
    each slot is looked up by the targets of three.
    """
    span = max(micros(tolerance), 1)
    at = epoch_micros(F.col("datetime"))
    times = records.where(F.col("datetime").isNotNull()).select(*dims, at.alias("_us"))
    slot = F.floor(F.col("_us") / F.lit(span)).cast("bigint")
    edges = times.groupBy(*dims, slot.alias("_slot")).agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"))
    wanted = targets.select(*dims, epoch_micros(F.col(target_time)).alias("_us")).where("_us IS NOT NULL").distinct()
    asked = wanted.withColumn("_slot", F.explode(F.sequence(slot - 1, slot + 1)))
    limit = F.lit(micros(tolerance))
    near = (F.abs(F.col("_first") - F.col("_us")) <= limit) | (F.abs(F.col("_last") - F.col("_us")) <= limit)
    own = F.col("_slot") == slot
    met = asked.join(edges, [*dims, "_slot"]).where(near | own & (limit >= span))
    found = met.select(*dims, "_us").distinct()
    keyed = targets.withColumn("_us", epoch_micros(F.col(target_time)))
    return keyed.join(found, [*dims, "_us"], "left_anti" if inverted else "left_semi").select(*targets.columns)
