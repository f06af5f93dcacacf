"""Helpers of the text operators: words, batches, samples and tokenizer files."""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows handled at once inside a task; texts of one slice are the only ones held as Python strings.
SLICE_ROWS = 256

_UPPER = range(0x41, 0x5B)
_ALNUM = [*range(0x30, 0x3A), *range(0x61, 0x7B)]

# Bytes of UTF-8: A-Z lowered, ASCII other than letters and digits to a blank.
ALNUM_TABLE = bytes(
    b + 32 if b in _UPPER else b if b >= 0x80 or b in _ALNUM else 32 for b in range(256)
)
# Bytes of UTF-8: A-Z lowered, the white space of ASCII to a blank.
BLANK_TABLE = bytes(b + 32 if b in _UPPER else 32 if b in range(9, 14) else b for b in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` as UTF-8."""
    return text.encode().translate(ALNUM_TABLE).split() if text else []


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def tokenizer_file(name: str) -> str:
    """Place of a public vocabulary file; ``TOKENIZER_DIR`` may name another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def touching(spans: Iterable[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Whether a stretch shares a character with any of the spans, by one search each."""
    ordered = sorted(spans)
    starts = [a for a, _ in ordered]
    reach = list(accumulate((b for _, b in ordered), max))

    def touches(a: int, b: int) -> bool:
        before = bisect_left(starts, b)
        return before > 0 and reach[before - 1] > a

    return touches


def id_fold(doc_id: str | Column, folds: int) -> Column:
    """Remainder of the CRC-32 of the id's decimal text; 0 for a missing id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(0))


def bounded_sample(df: DataFrame, group: str | None, payload: list[str], key: Column, size: int) -> DataFrame:
    """At most ``size`` rows of each value of ``group``, chosen by a hash of ``key``.

    Rows fall into ``size`` buckets by hash and the least of each bucket stays, so the
    sample is combined before the shuffle and no task sees more than its own rows.
    """
    hashed = df.withColumn("_h", F.xxhash64(key)).withColumn("_b", F.pmod(F.col("_h"), F.lit(size)))
    picked = hashed.groupBy(*([group] if group else []), "_b").agg(
        F.min_by(F.struct(*payload), F.struct(F.xxhash64("_h"), "_h")).alias("_row")
    )
    return picked.select(*([group] if group else []), "_row.*")


def spread_text(text: str, chars: int, pieces: int = 8) -> Column:
    """A text of at most ``chars`` characters as it is, of a longer one stretches from all over.

    The longer text falls into ``pieces`` equal parts, and each gives one stretch at a place
    chosen by a hash of its length, without the words cut at its ends. Null stays null.
    """
    size = chars // pieces
    part = (F.length(text) / pieces).cast("int")

    def stretch(i: Column) -> Column:
        place = F.pmod(F.xxhash64(F.length(text), i), F.greatest(part - size + 1, F.lit(1))).cast("int")
        piece = F.substr(F.col(text), i * part + place + 1, F.lit(size))
        return F.regexp_replace(piece, r"^\S+\s+|\s+\S+$", "")

    stretches = F.transform(F.sequence(F.lit(0), F.lit(pieces - 1)), stretch)
    return F.when(F.length(text) > chars, F.array_join(stretches, "\n")).otherwise(F.col(text))
