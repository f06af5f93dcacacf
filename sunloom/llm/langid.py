"""Language identification by compression with per-language zstandard dictionaries.

Each language has a raw-content dictionary: bounded pieces of a bounded sample of its
labelled texts. A text is compressed in blocks with each dictionary, and the language that
needs the fewest bytes wins; a margin below ``LEAST_MARGIN`` of the size is rejected in the
operator's own result. Only letters count: both sides are lowered, and runs of anything else
become one blank, so numbers, tables and shouting do not decide.

Results in odd cases: a null text, or one without a letter, is ``und`` with score 0; rows
without a language teach nothing; without any dictionary all is ``und``; ties go to the
language with more labelled texts, then by name; repeated rows get a row each; other columns are not read. Every
block of a long text counts.
"""

from __future__ import annotations

import re

import regex
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import bounded_sample, id_fold, slices, spread_text

FOLDS, HELD_OUT = 4, 2
# Of each language at most so many texts teach, and of all together; each gives so many
# characters at most, from all over it.
SAMPLE_TEXTS, ALL_TEXTS = 400, 160_000
SAMPLE_CHARS, PIECES = 600, 4
BLOCK = 4096
LEVEL = 3
LEAST_MARGIN = 0.01
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    return _OTHER.sub(" ", text.lower())


def dictionaries(documents: DataFrame) -> dict[str, bytes]:
    """Raw content for each language, from rows outside the held-out fold; most taught first."""
    taught = documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        id_fold("doc_id", FOLDS) != HELD_OUT
    )
    pieces = taught.select("lang", "doc_id", spread_text("text", SAMPLE_CHARS, PIECES).alias("piece"))
    counts = taught.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()
    each = max(1, min(SAMPLE_TEXTS, ALL_TEXTS // max(len(counts), 1)))
    sample = bounded_sample(pieces, "lang", ["piece"], F.col("piece"), each)
    content: dict[str, list[str]] = {row.lang: [] for row in counts}
    for row in sample.orderBy("lang", F.xxhash64("piece"), "piece").toLocalIterator():
        content[row.lang].append(letters(row.piece))
    return {lang: "\n".join(texts).encode() for lang, texts in content.items()}


def coders(content: dict[str, bytes]) -> list[tuple[str, zstandard.ZstdCompressor]]:
    made = []
    for lang, raw in content.items():
        data = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        made.append(
            (
                lang,
                zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False
                ),
            )
        )
    return made


def classify(text: str | None, made: list[tuple[str, zstandard.ZstdCompressor]]) -> tuple[str, float, bool]:
    """Language, score from 0 to 1, and whether the margin is wide enough."""
    if not made or text is None or not LETTER.search(text):
        return UNKNOWN, 0.0, False
    raw = letters(text).encode()
    blocks = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]
    sizes = sorted(
        ((sum(len(coder.compress(b)) for b in blocks), lang) for lang, coder in made), key=lambda pair: pair[0]
    )
    best = sizes[0]
    other = sizes[1][0] if len(sizes) > 1 else len(raw) + best[0]
    margin = (other - best[0]) / max(other, 1)
    return best[1], min(1.0, 0.5 + 5 * margin), margin >= LEAST_MARGIN


def identify(documents: DataFrame, content: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred, score and accepted for every row."""
    source = documents.select("doc_id", "text")
    held = documents.sparkSession.sparkContext.broadcast(content)
    target = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )

    def run(batches):
        made = coders(held.value)
        for batch in slices(batches):
            found = [classify(t, made) for t in batch.column("text").to_pylist()]
            if found:
                lang, score, accepted = (pa.array(c) for c in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), lang, score, accepted], names=["doc_id", "lang_pred", "score", "accepted"]
                )

    return source.mapInArrow(run, target)
