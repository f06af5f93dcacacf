"""Fixed-width text to columns, one narrow stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.numbers import bare_text, to_number
from sunloom.functions.stages import computed_once
from sunloom.sources.layouts import RecordLayout


# Beyond these characters a number may have forms that only the cast takes, like 12.5f.
_NOT_PLAIN = r"[^-+. 0-9]"
LINE_ORDER = ("source_path", "block_start", "line_id")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines with their order: by file, block in the file, line in the block."""
    lines = spark.read.text(path)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("line_id"),
    )


def parse_fixed_width(lines: DataFrame, layout: RecordLayout, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``value`` text cut by ``layout``; the timestamp comes first.

    A blank, short or malformed slice is NULL, as is a fill value. Only the line
    itself is cut: leading blanks of a line belong to its first field. ``keep``
    names other columns of ``lines`` to carry along.
    """
    # One pass of a pattern cuts the whole line; a line holds no line break, so that
    # can part the slices. The slices stay an array until they are numbers: one
    # short expression for all fields instead of one per field.
    pattern = "^" + "".join(f"(.{{{f.width}}})" for f in layout.fields)
    parted = "\n".join(f"${i}" for i, _ in enumerate(layout.fields, 1))
    line = F.rpad("value", layout.length, " ")
    slices = F.split(F.regexp_replace(line, pattern, parted), "\n")
    plain = ~F.col("value").rlike(_NOT_PLAIN)
    cut = computed_once(lines.where(F.trim("value") != ""), {"_slice": slices, "_plain": plain})
    # On a plain line the cast alone tells numbers, without the checks of each slice.
    quick = F.transform(F.transform("_slice", lambda text: F.trim(text)), lambda text: F.when(text != "", text.try_cast("double")))
    checked = F.transform(F.transform("_slice", bare_text), to_number)
    fills = F.array(*[F.lit(f.fill).cast("double") for f in layout.fields])
    numbers = F.zip_with(
        F.when(F.col("_plain"), quick).otherwise(checked),
        fills,
        lambda number, fill: F.when(fill.isNull() | (number != fill), number),
    )
    parsed = computed_once(cut, {"_number": numbers})
    cut = parsed.select(*keep, *[F.get("_number", F.lit(i)).alias(f.name) for i, f in enumerate(layout.fields)])
    return cut.select(*keep, layout.timestamp().alias("datetime"), *[f.name for f in layout.fields])
