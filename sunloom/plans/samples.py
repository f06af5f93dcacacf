"""Event windows and the labelled sample index over a half-hourly table."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunloom.functions.numbers import any_missing
from sunloom.functions.times import epoch_micros, from_micros, micros, ntz
from sunloom.operators.grids import in_ranges
from sunloom.operators.windows import Frame, moving_frames, with_row_index, with_running_totals

STEP = timedelta(minutes=30)


def event_window(
    table: DataFrame, reference: datetime, before: timedelta = timedelta(days=5), after: timedelta = timedelta(days=3)
) -> DataFrame:
    """Rows from ``reference - before`` to one step short of ``reference + after``."""
    lo, hi = reference - before, reference + after - STEP
    return table.where(F.col("datetime").between(ntz(lo), ntz(hi))).orderBy("datetime")


def _served(
    when: Column, start: datetime, end: datetime, cadence: timedelta, before: timedelta, after: timedelta
) -> tuple[Column, Column]:
    """First and last number of the reference times whose window holds ``when``.

    ``T - before <= when <= T + after - step``, T on the cadence grid from
    ``start`` to ``end``, counted from 0.
    """
    tick = micros(cadence)
    us = epoch_micros(when) - epoch_micros(ntz(start))
    lowest = F.greatest(F.ceil((us - micros(after - STEP)) / tick), F.lit(0)).cast("bigint")
    highest = F.least(F.floor((us + micros(before)) / tick), F.lit((end - start) // cadence)).cast("bigint")
    return lowest, highest


def clean_references(
    table: DataFrame,
    start: datetime,
    end: datetime,
    cadence: timedelta,
    before: timedelta,
    after: timedelta,
    require_complete: bool = False,
) -> DataFrame:
    """Numbers (``tick``) of the reference times whose window has rows and no missing cell.

    Missing cells and times are added up once along the series; a window's counts are the
    difference of two totals, looked up at its ends. So each reference time costs two rows,
    however long its window.
    """
    bad = any_missing(table, table.columns)
    counts = table.select("datetime", bad.cast("bigint").alias("bad")).groupBy("datetime").agg(F.sum("bad").alias("bad"))
    zero, nothing = epoch_micros(ntz(start)), F.lit(0).cast("bigint")
    series = counts.where(F.col("datetime").isNotNull()).select(
        (epoch_micros(F.col("datetime")) - zero).alias("us"),
        F.lit(1).alias("side"),
        F.lit(-1).cast("bigint").alias("tick"),
        "bad",
        F.lit(1).cast("bigint").alias("times"),
    )
    # A window's start is asked before the rows of its time, its end after them.
    spark = table.sparkSession
    ticks = spark.range(max((end - start) // cadence + 1, 0)).withColumnRenamed("id", "tick")
    ends = F.array(
        F.struct((F.col("tick") * micros(cadence) - micros(before)).alias("us"), F.lit(0).alias("side")),
        F.struct((F.col("tick") * micros(cadence) + micros(after - STEP)).alias("us"), F.lit(2).alias("side")),
    )
    asked = ticks.select("tick", F.inline(ends)).select("us", "side", "tick", nothing.alias("bad"), nothing.alias("times"))
    totals = with_running_totals(
        series.unionByName(asked), ("us", "side", "tick"), {"bad_so_far": "bad", "times_so_far": "times"}
    ).where("side <> 1")
    sign = F.col("side") - 1
    judged = totals.groupBy("tick").agg(
        F.sum(sign * F.col("bad_so_far")).alias("bad"), F.sum(sign * F.col("times_so_far")).alias("times")
    )
    wanted = F.col("times") == (before + after) // STEP if require_complete else F.col("times") > 0
    return judged.where((F.col("bad") == 0) & wanted).select("tick")


def event_windows(
    table: DataFrame,
    start: datetime,
    end: datetime,
    cadence: timedelta = STEP,
    before: timedelta = timedelta(days=5),
    after: timedelta = timedelta(days=3),
    require_complete: bool = False,
) -> DataFrame:
    """All windows without a missing cell, as rows tagged by ``reference_time``.

    Which reference times are clean is settled first, by ``clean_references``. These come
    in blocks as long as a window, so a row of the table meets two blocks at most and only
    then spreads to the clean windows that hold it. ``position`` counts the half hours
    from the window's start; ``require_complete`` also refuses windows with
    absent rows.
    """
    clean = clean_references(table, start, end, cadence, before, after, require_complete)
    length = max(-(-(before + after) // cadence), 1)
    block = F.floor(F.col("tick") / length).cast("bigint")
    blocks = clean.groupBy(block.alias("_block")).agg(F.collect_list("tick").alias("_ticks"))
    lowest, highest = _served(F.col("datetime"), start, end, cadence, before, after)
    spans = table.where("datetime IS NOT NULL").withColumn("_lo", lowest).withColumn("_hi", highest).where("_lo <= _hi")
    reached = F.sequence(F.floor(F.col("_lo") / length), F.floor(F.col("_hi") / length))
    met = spans.withColumn("_block", F.explode(reached)).join(blocks, "_block")
    held = F.filter("_ticks", lambda t: t.between(F.col("_lo"), F.col("_hi")))
    rows = met.select(*table.columns, F.explode(held).alias("_tick"))
    reference = epoch_micros(ntz(start)) + F.col("_tick") * micros(cadence)
    from_start = epoch_micros(F.col("datetime")) - (reference - micros(before))
    return rows.select(
        from_micros(reference).alias("reference_time"),
        (F.floor(from_start / micros(STEP)) + 1).cast("int").alias("position"),
        *table.columns,
    )


def classify_candidates(
    table: DataFrame,
    cadence: timedelta = STEP,
    before: int = 240,
    after: int = 144,
    label_column: str = "ap30",
    threshold: float = 30,
) -> DataFrame:
    """Candidate reference times with ``status`` (valid, missing_values, no_window) and ``label``.

    A window counts rows: ``before`` rows up to the reference row and ``after``
    rows from it on. Candidates lie on the cadence from ``before`` cadences after
    the first time to ``after`` cadences before the last one; the last row of a
    repeated time stands for it. The label is 1 if the label column reaches the
    threshold in the rows from the reference on, compared in single precision.
    """
    numeric = [c for c in table.columns if c != "datetime"]
    narrow = table.select(
        "datetime",
        any_missing(table, numeric).cast("int").alias("_bad"),
        F.col(label_column).cast("float").alias("_value"),
    )
    indexed = with_row_index(narrow, "datetime", "_bad", "_value")
    first, last, rows = indexed.agg(F.min("datetime"), F.max("datetime"), F.count("*")).first()
    if not rows:
        return indexed.select("datetime", F.lit("").alias("status"), F.lit(0).alias("label")).limit(0)
    lo, hi = first + cadence * before, last - cadence * after
    windowed = moving_frames(
        indexed,
        {
            "_bad_rows": Frame("sum", "_bad", -before, after - 1),
            "_peak": Frame("max", "_value", 0, after - 1),
            "_next": Frame("value", "datetime", 1, 1),
        },
    )
    when, row = F.col("datetime"), F.col("row_index")
    on_grid = F.pmod(epoch_micros(when) - epoch_micros(ntz(lo)), F.lit(micros(cadence))) == 0
    stands = F.col("_next").isNull() | (F.col("_next") > when)
    inside = (row >= before) & (row + after <= rows)
    status = F.when(~inside, "no_window").when(F.col("_bad_rows") > 0, "missing_values").otherwise("valid")
    label = (F.coalesce(F.col("_peak") >= F.lit(float(threshold)).cast("float"), F.lit(False))).cast("int")
    candidates = windowed.where(when.between(ntz(lo), ntz(hi)) & on_grid & stands)
    return candidates.select("datetime", status.alias("status"), label.alias("label"))


def sample_index(table: DataFrame, **options) -> DataFrame:
    """Reference times with a full window free of missing values, and their labels."""
    return classify_candidates(table, **options).where(F.col("status") == "valid").select("datetime", "label")


def skip_counts(
    table: DataFrame, cadence: timedelta = STEP, before: int = 240, after: int = 144, **options
) -> DataFrame:
    """Candidates by fate: ``valid``, ``missing_values``, ``missing`` (no row or no full window)."""
    judged = classify_candidates(table, cadence=cadence, before=before, after=after, **options)
    span = table.agg(F.min("datetime").alias("lo"), F.max("datetime").alias("hi"))
    width = epoch_micros(F.col("hi")) - epoch_micros(F.col("lo")) - micros(cadence) * (before + after)
    total = F.greatest(F.floor(width / micros(cadence)) + 1, F.lit(0)).cast("bigint")
    kept = judged.agg(
        F.count_if(F.col("status") == "valid").alias("valid"),
        F.count_if(F.col("status") == "missing_values").alias("missing_values"),
    )
    # Two one-row frames side by side.
    both = kept.withColumn("_one", F.lit(1)).join(span.select(total.alias("total"), F.lit(1).alias("_one")), "_one")
    missing = F.col("total") - F.col("valid") - F.col("missing_values")
    entries = [
        F.struct(F.lit(name).alias("status"), value.alias("n"))
        for name, value in (
            ("valid", F.col("valid")),
            ("missing_values", F.col("missing_values")),
            ("missing", missing),
        )
    ]
    return both.select(F.inline(F.array(*entries)))


def day_range(start: date, end: date) -> tuple[Column, Column]:
    """From the start of one day to the last second of another."""
    return ntz(datetime.combine(start, time.min)), ntz(datetime.combine(end, time(23, 59, 59)))


def split_samples(samples: DataFrame, splits: dict[str, tuple[date, date]]) -> DataFrame:
    """Samples tagged by ``phase``; overlapping splits share samples."""
    return in_ranges(samples, "datetime", {name: day_range(*days) for name, days in splits.items()})
