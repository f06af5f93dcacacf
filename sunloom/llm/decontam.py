"""Benchmark decontamination with one Aho-Corasick automaton over the test items.

Items and documents are normalised alike (A-Z lowered, everything but letters, digits and
non-ASCII to one blank). Each window of 13 consecutive item words is one pattern; a shorter
item is one pattern of its own. A document's normalised text is scanned once. Normalising
keeps the length of the UTF-8 text, so places of words map straight back to the original.

The automaton is bounded: items go into blocks of at most ``block_bytes`` of text (about 0.65
GB of automaton for 1 MB), read one after the other. Each further block is one more scan, over
a written table, so a large benchmark costs scans, not memory.

Results in odd cases: a null or empty text has no words and no hits; items without words,
without text or without id are no items; repeated items count once; repeated rows give a
row each; an empty benchmark marks nothing; other columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import ALNUM_TABLE, alnum_words, slices

WINDOW = 13
BLOCK_BYTES = 512 << 10

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("hit_words", T.BinaryType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])),
        ),
    ]
)


def item_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of bounded size, read one after the other."""
    items = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
        .where("item_id IS NOT NULL AND text IS NOT NULL")
        .distinct()
    )
    block, held = [], 0
    for row in items.toLocalIterator():
        if block and held + len(row.text) > block_bytes:
            yield block
            block, held = [], 0
        block.append((row.item_id, row.text))
        held += len(row.text)
    if block:
        yield block


def build_automaton(items: list[tuple[str, str]], window: int = WINDOW) -> ahocorasick.Automaton:
    patterns: dict[bytes, set[str]] = {}
    for item_id, text in items:
        words = alnum_words(text)
        for first in range(max(1, len(words) - window + 1) if words else 0):
            patterns.setdefault(b" " + b" ".join(words[first : first + window]) + b" ", set()).add(item_id)
    automaton = ahocorasick.Automaton()
    for pattern, ids in patterns.items():
        automaton.add_word(pattern.decode("latin-1"), (pattern.count(b" ") - 1, tuple(ids)))
    if patterns:
        automaton.make_automaton()
    return automaton


def scan(text: str | None, automaton) -> tuple[int, np.ndarray | None, set[str]]:
    """Number of words, which of them are hit (None: none), and the items found."""
    words = alnum_words(text)
    if not words or not len(automaton):
        return len(words), None, set()
    line = " " + b" ".join(words).decode("latin-1") + " "
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    for end, (length, ids) in automaton.iter(line):
        found.append((end, length))
        items.update(ids)
    if not found:
        return len(words), None, items
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), dtype=np.uint8) == 32)
    ends, lengths = np.array(found).T
    last = np.searchsorted(blanks, ends)
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edges, last - lengths, 1)
    np.add.at(edges, last, -1)
    return len(words), np.cumsum(edges[:-1]) > 0, items


def original_spans(text: str, hit: np.ndarray) -> list[dict[str, int]]:
    """Runs of hit words as code point offsets of the original text."""
    raw = text.encode()
    inside = np.frombuffer(raw.translate(ALNUM_TABLE), dtype=np.uint8) != 32
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    runs = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    first, last = np.flatnonzero(runs == 1), np.flatnonzero(runs == -1) - 1
    points = np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)
    return [{"start": int(points[a] - 1), "end": int(points[b - 1])} for a, b in zip(starts[first], ends[last])]


def _scanned(block, window: int, schema: pa.Schema, name: str, earlier: bool):
    def run(batches):
        automaton = build_automaton(block.value, window)
        for batch in slices(batches):
            before = batch.column(name).to_pylist() if earlier else [None] * batch.num_rows
            out = []
            for text, known in zip(batch.column("text").to_pylist(), before):
                n, hit, items = scan(text, automaton)
                if known and known["hit_words"]:
                    old = np.frombuffer(known["hit_words"], dtype=bool)
                    hit = old if hit is None else hit | old
                    items |= set(known["items"])
                out.append(
                    {
                        "n_words": n,
                        "n_hit": 0 if hit is None else int(hit.sum()),
                        "hit_words": None if hit is None else hit.tobytes(),
                        "items": sorted(items),
                        "spans": [] if hit is None else original_spans(text, hit),
                    }
                )
            columns = [c for c in batch.schema.names if c != name]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(out, schema.field(name).type)],
                schema=schema,
            )

    return run


def mark_contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    name: str = "_found",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns of ``documents`` and a new one, ``name``: words, hit words, items, spans."""
    from pyspark.sql.pandas.types import to_arrow_schema

    from sunloom.session import materialise

    target = T.StructType([*documents.schema.fields, T.StructField(name, FOUND)])

    def scanned(rows: DataFrame, items: list[tuple[str, str]], earlier: bool) -> DataFrame:
        held = documents.sparkSession.sparkContext.broadcast(items)
        return rows.mapInArrow(_scanned(held, window, to_arrow_schema(target), name, earlier), target)

    blocks = item_blocks(benchmark, block_bytes)
    marked = scanned(documents, next(blocks, []), False)
    for items in blocks:
        # Written, so that a task holds one automaton at a time.
        marked = scanned(materialise(marked, "marked"), items, True)
    return marked


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (ids as strings, sorted) and spans."""
    marked = mark_contamination(documents.select("doc_id", "text"), benchmark, window=window)
    return marked.select(
        "doc_id",
        F.col("_found.n_words").alias("n_words"),
        F.col("_found.n_hit").alias("n_hit"),
        F.col("_found.items").alias("items"),
        F.col("_found.spans").alias("spans"),
    )


def is_contaminated(n_words: F.Column, n_hit: F.Column) -> F.Column:
    """At least a twentieth of the words, and at least one, is part of a test item."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with all their columns."""
    name = "_found"
    while name in documents.columns:
        name += "_"
    marked = mark_contamination(documents, benchmark, name)
    return marked.where(~is_contaminated(F.col(name)["n_words"], F.col(name)["n_hit"])).drop(name)
