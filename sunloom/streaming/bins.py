"""Statistics of a stream in which no row is too late.

Each micro-batch adds one row a bin, its exact partial sums and extremes, to a stored
table of partials. Partials of a bin merge in any order, so rows behind the watermark
repair their bins by being added, and the stream's result is the batch's. A bin is open
until the watermark has passed it; what comes later is counted as late, row by row.

No state is kept in memory. The table is one of versions, so a batch is published once
however often it is tried, and partials of one bin are folded together by
``compact_bins`` while the stream and its readers go on.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sunloom import versions
from sunloom.functions.times import micros
from sunloom.operators.resample import merge_partials, merge_stats, partial_stats
from sunloom.session import materialise, scratch_scope

COUNTS = ("rows", "late_rows")
# The batches that partials come from, as the folders of a commit.
_BATCHES = "batches"


def _read(spark: SparkSession, out: str, base: versions.Version, columns: Sequence[str] | None = None) -> DataFrame:
    paths = [f"{out}/commit={commit}/{part}" for commit, part in base.parts]
    rows = spark.read.parquet(*paths)
    return rows.select(*columns) if columns else rows


def add_batch(batch: DataFrame, number: int, variables: dict[str, Column], every: timedelta, late: timedelta, out: str) -> bool:
    """Publish the partials of one batch; False if they are there already.

    The watermark of a batch is ``late`` before the last time of the batches before it;
    the first has none. A row is late if its bin ended at or before the watermark.
    """
    spark = batch.sparkSession
    partial = materialise(partial_stats(batch, variables, every), "partials")
    while True:
        base = versions.latest(spark, out) or versions.Version()
        if any(first <= number <= last for first, last in map(versions.span, base.parts)):
            return False
        seen = _read(spark, out, base, ["latest"]).agg(F.max("latest")).first()[0] if base.parts else None
        closed = F.lit(False)
        if seen is not None:
            ends = F.col("datetime") + F.expr(f"make_dt_interval(0, 0, 0, {micros(every)} / 1000000D)")
            closed = ends <= F.lit(seen - late).cast(partial.schema["datetime"].dataType)
        rows = partial.withColumn("late_rows", F.when(closed, F.col("rows")).otherwise(F.lit(0).cast("long")))
        # A batch without a row is published without a part; trying it again does no harm.
        if partial.isEmpty():
            return True
        parts = versions.write_parts(rows.withColumn(_BATCHES, F.lit(f"{number}-{number}")), out, _BATCHES)
        try:
            versions.publish(spark, out, base, parts)
            return True
        except versions.Conflict:
            versions.discard(spark, out, parts)


def stream_bins(
    rows: DataFrame,
    variables: dict[str, Column],
    every: timedelta,
    late: timedelta,
    out: str,
    checkpoint: str,
    once: bool = False,
) -> StreamingQuery:
    """Partials of a stream to ``out``; one checkpoint belongs to one ``out``."""

    def run(batch: DataFrame, number: int) -> None:
        with scratch_scope(batch.sparkSession):
            add_batch(batch, number, variables, every, late, out)

    writer = rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def bin_stats(spark: SparkSession, out: str, variables: Sequence[str]) -> DataFrame:
    """Statistics of every bin so far, with ``rows`` and how many of them were late."""
    base = versions.latest(spark, out)
    if base is None or not base.parts:
        raise FileNotFoundError(f"no partials below {out}")
    return merge_stats(_read(spark, out, base), variables, COUNTS)


def compact_bins(spark: SparkSession, out: str, variables: Sequence[str]) -> int:
    """Fold the partials of all batches so far to one row a bin; returns how many parts went."""
    while True:
        base = versions.latest(spark, out)
        if base is None or len(base.parts) < 2:
            return 0
        spans = [versions.span(p) for p in base.parts]
        merged = merge_partials(_read(spark, out, base), variables, COUNTS)
        span = f"{min(s[0] for s in spans)}-{max(s[1] for s in spans)}"
        parts = versions.write_parts(merged.withColumn(_BATCHES, F.lit(span)), out, _BATCHES)
        try:
            versions.publish(spark, out, base, parts, base.parts)
            return len(base.parts)
        except versions.Conflict:
            versions.discard(spark, out, parts)
