"""Token counts from piece counts of distinct pre-tokens.

A pre-token's number of pieces does not depend on its surroundings, so it is counted once
for each distinct pre-token of the corpus and joined to the pre-token frequencies of each
document; ids are never made. Pre-tokens above a share of the corpus would be hot join
keys. There are fewer than ``FREQUENT`` of them by definition, so their counts are broadcast
and summed where the document is read, and only the rarer ones are shuffled.

Results in odd cases: a null or empty text has zero bytes and tokens; special strings in a
text are one token each, as the library takes them; repeated rows and ids get a row each;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import slices, tokenizer_file

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
# A pre-token is frequent if more than one in FREQUENT occurrences is of it.
FREQUENT = 500_000
# Entries held by a task before they are handed on or forgotten.
HELD = 300_000

# Every version of the character tables agrees on what lies below.
COMMON = "ɐ"
# Fixed value: the pre-token pattern of the vocabulary, on normalised text.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# str.split() takes these for white space, the library does not.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class PreTokens:
    """Splits texts as the library does before it applies merges.

    White space always parts pre-tokens, and normalising is local to the runs between it,
    so each distinct run is split once and remembered up to a bound.
    """

    def __init__(self, name: str = VOCABULARY) -> None:
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(tokenizer_file(name))
        special = sorted((t.content for t in self.library.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special)))
        self.pattern = regex.compile(PRE_TOKEN)
        self.bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: dict[str, tuple[str, ...]] = {}

    def _split(self, run: str) -> tuple[str, ...]:
        if run.isascii():
            return (run.lower(),) if run.isalpha() else tuple(self.pattern.findall(run.lower()))
        if max(run) < COMMON:
            return tuple(self.pattern.findall(unicodedata.normalize("NFC", run).lower()))
        return tuple(self._exact(run))

    def _exact(self, text: str) -> list[str]:
        """Through the library, whatever the characters."""
        plain = self.library.normalizer.normalize_str(text)
        return [plain[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def pieces(self, run: str) -> tuple[str, ...]:
        """Pre-tokens of a run between white space."""
        known = self.known.get(run)
        if known is None:
            if len(self.known) >= HELD:
                self.known.clear()
            known = self.known[run] = self._split(run)
        return known

    def runs(self, text: str) -> tuple[list[str], list[str], int]:
        """Runs between white space, or else the pre-tokens themselves, and how many special
        strings there are."""
        specials = 0
        if "<|" in text:
            parts = self.special.split(text)
            specials, text = len(parts) - 1, "\n".join(parts)
        if _SEPARATORS.search(text):
            return [], self._exact(text), specials
        return text.split(), [], specials

    def frequencies(self, text: str) -> tuple[Counter, int]:
        """Pre-tokens with their counts, and the number of special strings."""
        runs, exact, specials = self.runs(text)
        counts = Counter(exact)
        for run, n in Counter(runs).items():
            for piece in self.pieces(run):
                counts[piece] += n
        return counts, specials

    def n_pieces(self, pre_token: str) -> int:
        (mapped, _), *more = self.bytes.pre_tokenize_str(pre_token)
        assert not more
        return len(self.library.model.tokenize(mapped))


VOCABULARY_SCHEMA = "pre_token string, n long"


def _vocabulary_counts(batches):
    split = PreTokens()
    runs: Counter = Counter()
    exact: Counter = Counter()

    def handed():
        for run, n in runs.items():
            for piece in split.pieces(run):
                exact[piece] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(exact), pa.string()), pa.array(list(exact.values()), pa.int64())], names=["pre_token", "n"]
        )
        runs.clear()
        exact.clear()

    for batch in slices(batches):
        for text in batch.column("text").to_pylist():
            if text:
                between, others, _ = split.runs(text)
                runs.update(between)
                exact.update(others)
        if len(runs) + len(exact) >= HELD:
            yield from handed()
    if runs or exact:
        yield from handed()


def _piece_counts(batches):
    split = PreTokens()
    for batch in batches:
        counts = [split.n_pieces(p) for p in batch.column("pre_token").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("pre_token"), batch.column("n"), pa.array(counts, pa.int32())],
            names=["pre_token", "n", "pieces"],
        )


def vocabulary(documents: DataFrame) -> DataFrame:
    """pre_token, n (occurrences) and pieces, one row for each distinct pre-token."""
    counted = documents.select("text").mapInArrow(_vocabulary_counts, VOCABULARY_SCHEMA)
    distinct = counted.groupBy("pre_token").agg(F.sum("n").alias("n"))
    return distinct.mapInArrow(_piece_counts, VOCABULARY_SCHEMA + ", pieces int")


def count_tokens(documents: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_bytes and n_tokens for every row."""
    from sunloom.session import materialise

    spark = documents.sparkSession
    words = materialise(vocabulary(documents), "vocabulary")
    total = words.agg(F.sum("n")).first()[0] or 0
    # More than total / frequent occurrences each: fewer than `frequent` rows.
    common = words.where(F.col("n") > total / frequent).select("pre_token", "pieces")
    known = spark.sparkContext.broadcast({r.pre_token: r.pieces for r in common.toLocalIterator()})
    source = documents.select("doc_id", "text", F.monotonically_increasing_id().alias("_row"))
    schema = T.StructType(
        [
            source.schema["doc_id"],
            T.StructField("row", T.LongType()),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("known", T.LongType()),
            T.StructField("rest", T.MapType(T.StringType(), T.LongType())),
        ]
    )
    rest_type = pa.map_(pa.string(), pa.int64())

    def run(batches):
        split, pieces = PreTokens(), known.value
        parted: dict[str, tuple[int, tuple[str, ...]]] = {}

        def part(run: str) -> tuple[int, tuple[str, ...]]:
            """Pieces of a run's known pre-tokens, and the others."""
            if len(parted) >= HELD:
                parted.clear()
            found = split.pieces(run)
            held = sum(pieces.get(p, 0) for p in found), tuple(p for p in found if p not in pieces)
            parted[run] = held
            return held

        for batch in slices(batches):
            sizes, sums, rests = [], [], []
            for text in batch.column("text").to_pylist():
                between, others, total = split.runs(text) if text else ([], [], 0)
                rest: dict[str, int] = {}
                for p in others:
                    if p in pieces:
                        total += pieces[p]
                    else:
                        rest[p] = rest.get(p, 0) + 1
                for run, n in Counter(between).items():
                    held, rare = parted.get(run) or part(run)
                    total += held * n
                    for p in rare:
                        rest[p] = rest.get(p, 0) + n
                sizes.append(len(text.encode()) if text else 0)
                sums.append(total)
                rests.append(list(rest.items()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_row"),
                    pa.array(sizes, pa.int64()),
                    pa.array(sums, pa.int64()),
                    pa.array(rests, rest_type),
                ],
                names=["doc_id", "row", "n_bytes", "known", "rest"],
            )

    # Written once: the row numbers stay as they are, and texts are not split again.
    split = materialise(source.mapInArrow(run, schema), "pre-token-frequencies")
    rare = split.select("row", F.explode("rest").alias("pre_token", "n"))
    joined = rare.join(words.where(F.col("n") <= total / frequent).select("pre_token", "pieces"), "pre_token")
    sums = joined.groupBy("row").agg(F.sum(F.col("n") * F.col("pieces")).alias("rare"))
    return (
        split.select("doc_id", "row", "n_bytes", "known")
        .join(sums, "row", "left")
        .select("doc_id", "n_bytes", (F.col("known") + F.coalesce("rare", F.lit(0))).alias("n_tokens"))
    )
