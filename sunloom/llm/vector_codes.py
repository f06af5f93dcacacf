"""Codes for vectors: one codebook entry for each part, found by equal-average search.

Components become integers, so every sum and distance is exact. The entries of a part's
codebook are sorted by component sum. A part starts at its own sum and goes outward both
ways: by Cauchy's inequality the squared gap of two sums over the dimension is at most the
squared distance, so a way ends once that bound strictly exceeds the best distance (at
equality a lower index may still tie). All parts of a batch take their steps together.

A round is one job that adds up parts by entry before the shuffle; the driver gets at most
``PARTS * ENTRIES`` rows of sums, whatever the number of vectors.

Results in odd cases: vectors that are null or hold null or non-finite components are left
out, and so are vectors of another length than the one with the least vec_id; fewer kept
vectors than entries give as many entries; equal starting entries go to the lower index;
repeated rows are coded each; a row without vec_id sorts last; a null label is a label; an
empty table gives an empty result; other columns are not read. A length that is not a
multiple of ``PARTS`` is an error, and so is a component of ``REACH / SCALE`` divided by a
part's length, or more: beyond it sums might leave 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
# Integer components stay below this over the length of a part, so that squared sums of a
# part and errors of a vector fit 64 bits.
REACH = 1 << 28


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, label and the components floor(4096 x) of each usable vector."""
    source = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    usable = F.col("v").isNotNull() & ~F.exists(
        "v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    )
    return source.where(usable & (F.size("v") > 0)).select(
        "vec_id", "label", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v")
    )


def _matrix(column: pa.Array, parts: int, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and max(-int(flat.min()), int(flat.max())) >= REACH // dim:
        raise ValueError(f"a component is {REACH // dim // SCALE} or more")
    return flat.reshape(-1, parts * dim)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower) and squared distance, for each row."""
    rows, dim = parts.shape
    sums, by_sum = parts.sum(axis=1), np.argsort(book.sum(axis=1), kind="stable")
    ordered, levels = book[by_sum], book.sum(axis=1)[by_sum]
    best = np.full(rows, np.iinfo(np.int64).max)
    index = np.full(rows, len(book))

    def step(active: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Tries the entries at ``at``; returns the rows whose bound does not exceed their best."""
        gap = sums[active] - levels[at]
        # gap^2 / dim > best, in whole numbers
        close = -(-gap * gap // dim) <= best[active]
        active, at = active[close], at[close]
        away = parts[active] - ordered[at]
        distance, entry = (away * away).sum(axis=1), by_sum[at]
        better = (distance < best[active]) | ((distance == best[active]) & (entry < index[active]))
        best[active[better]], index[active[better]] = distance[better], entry[better]
        return close

    up = np.searchsorted(levels, sums)
    down, rising, falling = up - 1, np.arange(rows), np.arange(rows)
    while len(rising) or len(falling):
        rising = rising[up[rising] < len(book)]
        rising = rising[step(rising, up[rising])]
        up[rising] += 1
        falling = falling[down[falling] >= 0]
        falling = falling[step(falling, down[falling])]
        down[falling] -= 1
    return index, best


def _first_vectors(vectors: DataFrame, entries: int) -> list:
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    return [r.v for r in vectors.orderBy(*order).limit(entries).collect()]


def _entry_sums(vectors: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """For each part and used entry the number of parts and their sums by component."""
    parts, _, dim = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column("v"), parts, dim)
            rows: list[tuple] = []
            for p in range(parts):
                own = matrix[:, p * dim : (p + 1) * dim]
                index, _ = nearest(own, books[p])
                order = np.argsort(index, kind="stable")
                used, begins, counts = np.unique(index[order], return_index=True, return_counts=True)
                sums = np.add.reduceat(own[order], begins) if len(begins) else own
                rows += [(p, int(e), int(n), s) for e, n, s in zip(used, counts, sums.tolist())]
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))],
                names=["part", "entry", "n", "sums"],
            )

    partial = vectors.select("v").mapInArrow(run, "part int, entry int, n long, sums array<long>")
    whole = [F.sum(F.col("sums")[k].cast("decimal(38,0)")).alias(f"s{k}") for k in range(dim)]
    found = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *whole).collect()
    return {(r.part, r.entry): (r.n, [int(r[f"s{k}"]) for k in range(dim)]) for r in found}


def train_codebooks(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> np.ndarray | None:
    """Codebooks (part, entry, component) of ``whole_vectors``; None without any vector."""
    first = _first_vectors(vectors, entries)
    if not first:
        return None
    size = len(first[0])
    if size % parts:
        raise ValueError(f"vectors of {size} components cannot be cut into {parts} equal parts")
    alike = vectors.where(F.size("v") == size)
    if any(len(v) != size for v in first):
        first = _first_vectors(alike, entries)
    books = np.array(first, dtype=np.int64).reshape(len(first), parts, size // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        for (p, e), (n, sums) in _entry_sums(alike, books).items():
            books[p, e] = [s // n for s in sums]
    return books


def encode(vectors: DataFrame, books: np.ndarray | None) -> DataFrame:
    """vec_id, label, code (an index for each part) and error, the squared distances' sum."""
    schema = "vec_id long, label int, code binary, error long"
    source = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("int"), "v")
    if books is None:
        return source.limit(0).selectExpr("vec_id", "label", "CAST('' AS BINARY) AS code", "0L AS error")
    parts, _, dim = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column("v"), parts, dim)
            found = [nearest(matrix[:, p * dim : (p + 1) * dim], books[p]) for p in range(parts)]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = sum(d for _, d in found)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error)],
                names=["vec_id", "label", "code", "error"],
            )

    return source.where(F.size("v") == parts * dim).mapInArrow(run, schema)


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components in order of part, entry and place."""
    values = [] if books is None else books.ravel().tolist()
    return hashlib.sha256(",".join(map(str, values)).encode()).hexdigest()


def compress(embeddings: DataFrame) -> tuple[DataFrame, np.ndarray | None]:
    """Codes of all usable vectors with the error of their label, and the codebooks."""
    from sunloom.session import materialise

    vectors = materialise(whole_vectors(embeddings), "vectors")
    books = train_codebooks(vectors)
    coded = materialise(encode(vectors, books), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = coded.alias("c").join(by_label.alias("l"), F.expr("c.label <=> l.label"))
    return joined.select("vec_id", "c.label", "code", "error", "label_error"), books
