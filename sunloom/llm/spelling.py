"""Spelling variants: words one edit apart, found by grams of variable length.

The words of a corpus are counted over all documents. Grams of ``SHORTEST`` to ``LONGEST``
characters of the padded words are counted too; those in at least so many words are the
frequent ones, with the least count that leaves at most ``MOST_GRAMS``. At each place a
word takes the shortest gram that is not frequent, or the longest one: frequent grams are
divided by one more character, rare ones are kept short. Whether a gram is taken depends on
its own characters alone, so an edit affects only the grams that hold its place, at most
``LONGEST`` of them. A word with g grams of which an edit affects at most a therefore
shares g - a grams with any word one edit away, each at the same distance from the start
(before the edit) or from the end (after it).

Lists are merged under that bound: a - g + 1 lists may be left out, the longest ones, since
two words that share g - a grams must meet in one of the others. Frequent grams come last
in the order, by count, the rest by hash. What meets is verified by the edit distance.

Results in odd cases: null and empty texts have no words; a null doc_id counts as an empty
text before the colon; repeated rows count twice; an empty table gives an empty result;
other columns are not read. Words shorter than ``LEAST_LENGTH`` could lose all grams to one
edit and are not taken.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunloom.llm.common import slices

LEAST_LENGTH = 5
LEAST_COUNT = 3
SHORTEST, LONGEST = 2, 5
# Frequent grams travel to all tasks: 16 bytes each.
LEAST_FREQUENT = 16
MOST_GRAMS = 2_000_000
DAMAGE = 97
# Words that a task counts before it sends them on.
HELD_WORDS = 200_000

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL1, _MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MUL1
    x = (x ^ (x >> np.uint64(27))) * _MUL2
    return x ^ (x >> np.uint64(31))


def document_words(doc_id, text: str | None) -> Counter:
    """Counts of a document's runs of letters, a few of them short of one character.

    A run whose CRC-32 with the doc_id is divisible by ``DAMAGE`` loses a character.
    """
    counts: Counter = Counter()
    prefix = b"%s:" % (b"" if doc_id is None else str(doc_id).encode())
    begun = zlib.crc32(prefix)
    for run, n in Counter(_RUN.findall(text.translate(_LOWER)) if text else ()).items():
        h = zlib.crc32(run.encode(), begun)
        if h % DAMAGE == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        counts[run] += n
    return counts


def word_counts(documents: DataFrame, least_length: int = LEAST_LENGTH, least: int = LEAST_COUNT) -> DataFrame:
    """word and n, its occurrences in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"]
            )

        for batch in slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                for word, n in document_words(key, text).items():
                    if len(word) >= least_length:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield counted()
                    held.clear()
        if held:
            yield counted()

    partial = documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def padded_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Characters of the words between two marks, zero behind, and the padded lengths."""
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    codes = np.zeros((len(words), int(lengths.max(initial=2)) + LONGEST), dtype=np.uint64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths - 2) - (lengths - 2), lengths - 2)
    codes[np.repeat(np.arange(len(words)), lengths - 2), place + 1] = flat
    codes[:, 0] = 1
    codes[np.arange(len(words)), lengths - 1] = 2
    return codes, lengths


def _gram_names(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Length and names of the grams that begin at each place, from the shortest on."""
    places = codes.shape[1] - LONGEST
    name = np.zeros((len(codes), places), dtype=np.uint64)
    for k in range(LONGEST):
        name = _mix(name * _ODD + codes[:, k : k + places] + np.uint64(k + 1))
        if k + 1 >= SHORTEST:
            yield k + 1, name


def frequent_grams(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted names and counts of the frequent grams, at most ``MOST_GRAMS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, lengths = padded_matrix(batch.column("word").to_pylist())
            places = np.arange(codes.shape[1] - LONGEST)
            names = np.concatenate(
                [name[places + size <= lengths[:, None]] for size, name in _gram_names(codes)]
            )
            name, n = np.unique(names, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(n)], names=["gram", "n"])

    grams = words.select("word").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    sizes = range(SHORTEST, LONGEST + 1)
    total = words.agg(F.sum(sum(F.greatest(F.length("word") + 3 - s, F.lit(0)) for s in sizes))).first()[0] or 0
    # At most total / least grams occur ``least`` times.
    least = max(LEAST_FREQUENT, -(-total // MOST_GRAMS))
    found = grams.where(F.col("n") >= least).toArrow()
    name = found.column("gram").to_numpy().view(np.uint64)
    order = np.argsort(name)
    return name[order], found.column("n").to_numpy()[order]


class Grams:
    """The variable-length grams of some words."""

    def __init__(self, words: list[str], frequent: np.ndarray, counts: np.ndarray):
        codes, lengths = padded_matrix(words)
        places = np.arange(codes.shape[1] - LONGEST)
        shape = (len(words), len(places))
        self.size, self.name = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.uint64)
        # 0: not frequent, so a short list; else the list's length.
        self.count = np.zeros(shape, dtype=np.int64)
        for size, name in _gram_names(codes):
            there = places + size <= lengths[:, None]
            at = np.minimum(np.searchsorted(frequent, name), max(len(frequent) - 1, 0))
            often = np.where(frequent[at] == name, counts[at], 0) if len(frequent) else np.zeros(shape, dtype=np.int64)
            # The gram one shorter was frequent, or there is none.
            longer = there & ((self.size == 0) | (self.count > 0))
            self.size[longer], self.name[longer], self.count[longer] = size, name[longer], often[longer]
        self.lengths, self.places = lengths, places
        self.taken = self.size > 0

    def affected(self) -> np.ndarray:
        """Per word the most grams that hold one and the same place."""
        change = np.zeros((len(self.size), self.size.shape[1] + LONGEST + 1), dtype=np.int64)
        row, at = np.nonzero(self.taken)
        np.add.at(change, (row, at), 1)
        np.add.at(change, (row, at + self.size[row, at]), -1)
        return np.cumsum(change, axis=1).max(axis=1, initial=0)

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        """Word and key of the lists to merge: gram and distance from either end."""
        grams = self.taken.sum(axis=1)
        # So many lists, and those that tie with the last one, cannot all be missed.
        needed = np.minimum(self.affected() + 1, grams)
        row, at = np.nonzero(self.taken)
        count, name = self.count[row, at], self.name[row, at]
        order = np.lexsort((name, count, row))
        row, at, count, name = row[order], at[order], count[order], name[order]
        begins = np.searchsorted(row, np.arange(len(grams)))
        last = begins[row] + needed[row] - 1
        stays = (count < count[last]) | ((count == count[last]) & (name <= name[last]))
        row, at, name = row[stays], at[stays], name[stays]
        since = _mix(name + np.uint64(1) + at.astype(np.uint64) * _ODD)
        until = _mix(~name + (self.lengths[row] - at).astype(np.uint64) * _ODD)
        return np.concatenate([row, row]), np.concatenate([since, until])


def near_words(words: DataFrame) -> DataFrame:
    """Pairs a < b of the given words one edit apart, with their counts n_a and n_b."""
    frequent, counts = frequent_grams(words)
    shared = words.sparkSession.sparkContext.broadcast((frequent, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            row, key = Grams(batch.column("word").to_pylist(), *shared.value).merged()
            whole = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), whole.column("word"), whole.column("n")], names=["key", "word", "n"]
            )

    lists = words.select("word", "n").mapInArrow(run, "key long, word string, n long")
    a, b = (lists.selectExpr("key", f"word AS {x}", f"n AS n_{x}") for x in ("a", "b"))
    one = F.expr("a < b AND abs(length(a) - length(b)) <= 1 AND levenshtein(a, b, 1) = 1")
    # A size is estimated from the words, not from their many lists, so either side may look
    # small enough to be broadcast through the driver.
    return a.join(b.hint("merge"), "key").where(one).select("a", "b", "n_a", "n_b").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """word and root, the end of its chain of forms, for the words with a form.

    A form is at least twice as frequent, so chains are short; each round doubles the reach.
    """
    from sunloom.session import materialise

    reach, open_ends = materialise(forms.selectExpr("word", "form AS root"), "roots"), None
    while open_ends != 0:
        onward = reach.selectExpr("word AS root", "root AS further")
        step = reach.join(onward, "root", "left")
        reach = materialise(
            step.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "roots",
        )
        open_ends = reach.where("moved").count()
        reach = reach.select("word", "root")
    return reach


def variants(documents: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root for every word of ``word_counts``.

    The form is the near word of largest n (ties: the least), if it is twice as frequent at
    least; the root is the last word that the forms lead to.
    """
    from sunloom.session import materialise

    words = materialise(word_counts(documents), "words")
    pairs = materialise(near_words(words), "near")
    both = pairs.selectExpr("a AS word", "n_a AS n", "b AS other", "n_b AS other_n").unionAll(
        pairs.selectExpr("b", "n_b", "a", "n_a")
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("best"),
        F.first("n").alias("own_n"),
    )
    named = best.select(
        "word",
        "n_near",
        F.when(-F.col("best.m") >= 2 * F.col("own_n"), F.col("best")).alias("best"),
    ).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n"))
    named = materialise(named, "forms")
    roots = _roots(named.where("form IS NOT NULL"))
    return (
        words.join(named, "word", "left")
        .join(roots, "word", "left")
        .select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form",
            "form_n",
            F.coalesce("root", "word").alias("root"),
        )
    )
