"""Removal of long passages that repeat across documents, by recompression.

Words get names, then runs of one word get a name, then in each of ``LEVELS`` levels every
name is a left or a right one by a bit of its hash and each left name followed by a right
one becomes one symbol. A name is a fingerprint of what it stands for, so all tasks give
equal passages the same names without a dictionary. What a passage determines by itself,
wherever it stands, are the symbols whose context (the words that decide the symbol) lies
inside it; only its ends may be parsed otherwise.

Round one finds the symbols of the highest level that more than one document holds. A
window with a symbol of its own that no other document has cannot repeat. Round two names
the windows left, by 96 bits of fingerprint, and finds the least document of each. A round
is one shuffle: each chunk of documents sends its distinct names, grouped by a range of
names, and gets a bit for each one back.

Chunks and ranges are bounded in size; a name in a third of all documents is one entry of
each chunk. Chunks are a written table, so a lost executor changes nothing.

Results in odd cases: null and empty texts have no words; a window that repeats inside one
document only stays; rows with the same doc_id do not remove each other's words; a row
without doc_id counts as later than all others; each row gets a row; an empty table gives
an empty result; other columns are not read. Texts are handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sunloom.llm.common import slices

WINDOW = 13
LEVELS = 3
# Bytes of text in a chunk, if no single text is longer, and words for each range of names.
CHUNK_BYTES = 4 << 20
RANGE_WORDS = 500_000
FEWEST_RANGES = 64

# Rows that meet in a group: a chunk's texts (kind 0), answers of rounds one and two.
ROWS = "key long, kind int, part long, n long, ids array<long>, payload binary"
_ARROW_ROWS = pa.schema(
    [
        ("key", pa.int64()),
        ("kind", pa.int32()),
        ("part", pa.int64()),
        ("n", pa.int64()),
        ("ids", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
LAST = np.iinfo(np.int64).max
_FAR = 1 << 40
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MUL1, _MUL2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MUL1
    x = (x ^ (x >> np.uint64(27))) * _MUL2
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Number of each distinct word; its two 64-bit names are in ``names()``."""

    def __init__(self):
        super().__init__()
        self._digests = bytearray()

    def __missing__(self, word: bytes) -> int:
        self._digests += xxhash.xxh3_128_digest(word)
        self[word] = number = len(self)
        return number

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        both = np.frombuffer(bytes(self._digests), dtype=np.uint64).reshape(-1, 2)
        return both[:, 0].copy(), both[:, 1].copy()


class Chunk:
    """The words of some documents in one row, with their names."""

    def __init__(self, ids: list, payload: bytes):
        self.ids = np.array([LAST if k is None else k for k in ids], dtype=np.int64)
        data = zstandard.decompress(payload) if payload else b""
        self.lines = data.split(b"\n")
        self.words = data.split()
        self.counts = np.array([x.count(b" ") + 1 if x else 0 for x in self.lines], dtype=np.int64)
        known = _Words()
        numbers = np.fromiter(map(known.__getitem__, self.words), dtype=np.int64, count=len(self.words))
        low, high = known.names()
        self.low, self.high = low[numbers], high[numbers]
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.first = np.zeros(len(self.words), dtype=bool)
        self.first[self.starts[:-1][self.counts > 0]] = True


def symbols(names: np.ndarray, first: np.ndarray, levels: int = LEVELS) -> tuple[np.ndarray, ...]:
    """Name, first word, and context (from, to) of each symbol of the highest level.

    ``first`` marks the words that begin a document. Contexts that reach over a document's
    end are out of any window.
    """
    size = len(names)
    if not size:
        none = np.zeros(0, dtype=np.int64)
        return names, none, none, none
    edge = first.copy()
    edge[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(edge)
    end = np.append(at[1:], size)
    length = (end - at).astype(np.uint64)
    name = np.where(length > 1, _mix(names[at] + length * _ODD), names[at])
    begins = first[at]
    closes = np.append(begins[1:], True)
    since, until = np.where(begins, -_FAR, at - 1), np.where(closes, _FAR, end + 1)
    for level in range(levels):
        right = (_mix(name ^ np.uint64(level + 1)) >> np.uint64(63)).astype(bool)
        head = np.zeros(len(name), dtype=bool)
        head[:-1] = ~right[:-1] & right[1:] & ~begins[1:]
        tail = np.concatenate([[False], head[:-1]])
        # A left symbol depends on the next one, a right symbol on the one before.
        after = np.where(closes, _FAR, np.append(until[1:], _FAR))
        before = np.where(begins, -_FAR, np.concatenate([[-_FAR], since[:-1]]))
        until, since = np.where(right, until, after), np.where(right, before, since)
        pair = np.flatnonzero(head)
        name[pair] = _mix(_mix(name[pair]) + name[pair + 1] * _ODD)
        closes[pair] = closes[pair + 1]
        stay = ~tail
        name, at, begins, closes, since, until = (
            x[stay] for x in (name, at, begins, closes, since, until)
        )
    return name, at, since, until


def _range_of(names: np.ndarray, ranges: int) -> np.ndarray:
    """Number of the range of each name; grows with the name."""
    return ((names >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


def _cuts(names: np.ndarray, ranges: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of sorted names, and where each begins, with the end."""
    parts = _range_of(names, ranges)
    begins = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else parts[:0]
    return parts[begins].astype(np.int64), np.append(begins, len(names)).astype(np.int64)


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts by the keys, the first row of each group in it, each row's group."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
    differs = np.zeros(len(order), dtype=bool)
    differs[:1] = True
    for key in keys:
        ordered = key[order]
        differs[1:] |= ordered[1:] != ordered[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(differs) - 1
    return order, np.flatnonzero(differs), group


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(payload: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(payload, dtype=np.uint8), count=n).astype(bool)


class _Names:
    """The distinct symbols of a chunk that a window may hold with their whole context."""

    def __init__(self, chunk: Chunk, window: int):
        name, at, since, until = symbols(chunk.low, chunk.first)
        inside = until - since <= window
        name, at, self.since, self.until = name[inside], at[inside], since[inside], until[inside]
        order, begins, self.group = _groups(name)
        self.distinct = name[order][begins]
        doc = chunk.doc[at][order]
        several = np.minimum.reduceat(doc, begins) != np.maximum.reduceat(doc, begins) if len(begins) else []
        self.several = np.asarray(several, dtype=bool)


class _Windows:
    """The windows of a chunk that may repeat, and the distinct ones with their least id."""

    def __init__(self, chunk: Chunk, names: _Names, shared: np.ndarray, window: int):
        size = len(chunk.words)
        dead = np.zeros(size + 1, dtype=np.int64)
        own = ~shared[names.group]
        np.add.at(dead, np.maximum(names.until[own] - window, 0), 1)
        np.add.at(dead, names.since[own] + 1, -1)
        ends = np.repeat(chunk.starts[1:], chunk.counts)
        self.at = np.flatnonzero((np.cumsum(dead)[:size] == 0) & (np.arange(size) + window <= ends))
        low = np.zeros(len(self.at), dtype=np.uint64)
        high = np.zeros(len(self.at), dtype=np.uint64)
        for k in range(window):
            low, high = low * _ODD + chunk.low[self.at + k], high * _MUL1 + chunk.high[self.at + k]
        low, high = _mix(low), (_mix(high) >> np.uint64(32)).astype(np.uint32)
        self.ids = chunk.ids[chunk.doc[self.at]]
        order, begins, self.group = _groups(low, high)
        self.low, self.high = low[order][begins], high[order][begins]
        self.least = np.minimum.reduceat(self.ids[order], begins) if len(begins) else self.ids


def _chunks(documents: DataFrame, chunk_bytes: int) -> DataFrame:
    """Rows of kind 0: texts as words with a blank between and a line for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=3)
        number, ids, lines, held, words = 0, [], [], 0, 0

        def full() -> pa.RecordBatch:
            row = [[base + number], [0], [0], [words], [ids], [pack.compress(b"\n".join(lines))]]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, _ARROW_ROWS.types)], schema=_ARROW_ROWS
            )

        for batch in slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                split = text.encode().split() if text else []
                line = b" ".join(split)
                if ids and held + len(line) > chunk_bytes:
                    yield full()
                    number, ids, lines, held, words = number + 1, [], [], 0, 0
                ids.append(key)
                lines.append(line)
                held += len(line) + 1
                words += len(split)
        if ids:
            yield full()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def _rows(rows: list[tuple]) -> pa.Table:
    """Rows (key, kind, part, n, payload)."""
    key, kind, part, n, payload = zip(*rows) if rows else [()] * 5
    ids = [None] * len(key)
    columns = [pa.array(v, t) for v, t in zip((key, kind, part, n, ids, payload), _ARROW_ROWS.types)]
    return pa.Table.from_arrays(columns, schema=_ARROW_ROWS)


def _gathered(table: pa.Table) -> tuple[Chunk, int, list[np.ndarray]]:
    """A group's chunk, its number, and the answers of each round in the order of the names."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["kind"], r["part"]))
    answers = [
        np.concatenate([np.zeros(0, dtype=bool)] + [_flags(r["payload"], r["n"]) for r in rows if r["kind"] == k])
        for k in (1, 2)
    ]
    return Chunk(rows[0]["ids"], rows[0]["payload"]), rows[0]["key"], answers


def _ask_symbols(chunks: DataFrame, ranges: int, window: int) -> DataFrame:
    """The distinct symbols of each chunk: low 32 bits, and whether several documents have it.

    Two names that agree in range and low bits count as one; that only leaves windows in.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                names = _Names(Chunk(row["ids"], row["payload"]), window)
                parts, cuts = _cuts(names.distinct, ranges)
                low = names.distinct.astype(np.uint32)
                yield from _rows(
                    [
                        (int(p), 0, row["key"], int(b - a), low[a:b].tobytes() + _bits(names.several[a:b]))
                        for p, a, b in zip(parts, cuts, cuts[1:])
                    ]
                ).to_batches()

    return chunks.mapInArrow(run, ROWS)


def _answer(kind: int, table: pa.Table, flags_of) -> pa.Table:
    rows = table.to_pylist()
    flags = flags_of([(r["payload"], r["n"]) for r in rows])
    cuts = np.cumsum([0] + [r["n"] for r in rows])
    return _rows(
        [(r["part"], kind, r["key"], r["n"], _bits(flags[a:b])) for r, a, b in zip(rows, cuts, cuts[1:])]
    )


def _shared_symbols(asked: DataFrame) -> DataFrame:
    """For each chunk and range a bit for each name: more than one document has it."""

    def flags(parts: list[tuple[bytes, int]]) -> np.ndarray:
        names = np.concatenate([np.frombuffer(p, dtype=np.uint32, count=n) for p, n in parts])
        several = np.concatenate([_flags(p[4 * n :], n) for p, n in parts])
        _, begins, group = _groups(names)
        counts = np.diff(np.append(begins, len(names)))
        return ((counts > 1) | (np.bincount(group, weights=several, minlength=len(begins)) > 0))[group]

    return asked.groupBy("key").applyInArrow(lambda table: _answer(1, table, flags), ROWS)


def _ask_windows(met: DataFrame, ranges: int, window: int) -> DataFrame:
    """The distinct windows of each chunk that may repeat: 96 bits and the least doc_id."""

    def run(table: pa.Table) -> pa.Table:
        chunk, number, (shared, _) = _gathered(table)
        found = _Windows(chunk, _Names(chunk, window), shared, window)
        parts, cuts = _cuts(found.low, ranges)
        rows = []
        for p, a, b in zip(parts, cuts, cuts[1:]):
            ids = zstandard.compress(found.least[a:b].tobytes())
            rows.append((int(p), 0, number, int(b - a), found.low[a:b].tobytes() + found.high[a:b].tobytes() + ids))
        return _rows(rows)

    return met.groupBy("key").applyInArrow(run, ROWS)


def _earlier_windows(asked: DataFrame) -> DataFrame:
    """For each chunk and range a bit for each window: a smaller doc_id has it elsewhere."""

    def flags(parts: list[tuple[bytes, int]]) -> np.ndarray:
        low = np.concatenate([np.frombuffer(p, dtype=np.uint64, count=n) for p, n in parts])
        high = np.concatenate([np.frombuffer(p, dtype=np.uint32, count=n, offset=8 * n) for p, n in parts])
        least = np.concatenate([np.frombuffer(zstandard.decompress(p[12 * n :]), dtype=np.int64) for p, n in parts])
        order, begins, group = _groups(low, high)
        return np.minimum.reduceat(least[order], begins)[group] < least

    return asked.groupBy("key").applyInArrow(lambda table: _answer(2, table, flags), ROWS)


def _without_repeats(met: DataFrame, window: int) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
    )

    def run(table: pa.Table) -> pa.Table:
        chunk, _, (shared, earlier) = _gathered(table)
        found = _Windows(chunk, _Names(chunk, window), shared, window)
        repeats = found.at[earlier[found.group] | (found.least[found.group] < found.ids)]
        covered = np.zeros(len(chunk.words) + window + 1, dtype=np.int64)
        covered[repeats] += 1
        covered[repeats + window] -= 1
        gone = np.cumsum(covered)[: len(chunk.words)] > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[chunk.starts])
        texts = []
        for k, line in enumerate(chunk.lines):
            if removed[k]:
                a, b = chunk.starts[k], chunk.starts[k + 1]
                line = b" ".join([w for w, out in zip(chunk.words[a:b], gone[a:b].tolist()) if not out])
            texts.append(line.decode())
        ids = pa.array(chunk.ids, mask=chunk.ids == LAST)
        return pa.Table.from_arrays(
            [ids, pa.array(chunk.counts), pa.array(removed), pa.array(texts, pa.string())], schema=schema
        )

    return met.groupBy("key").applyInArrow(run, "doc_id long, n_words long, n_removed long, kept_text string")


def remove_repeats(
    documents: DataFrame, window: int = WINDOW, chunk_bytes: int = CHUNK_BYTES, range_words: int = RANGE_WORDS
) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text for every row of ``documents``.

    A word goes if a window of ``window`` words that covers it also stands in a document
    with a smaller doc_id; the kept words are joined by a blank.
    """
    from sunloom.session import materialise

    chunks = materialise(_chunks(documents, chunk_bytes), "chunks")
    words = chunks.agg(F.sum("n")).first()[0] or 0
    ranges = max(FEWEST_RANGES, words // range_words)
    shared = materialise(_shared_symbols(_ask_symbols(chunks, ranges, window)), "shared")
    met = chunks.unionByName(shared)
    earlier = materialise(_earlier_windows(_ask_windows(met, ranges, window)), "earlier")
    return _without_repeats(met.unionByName(earlier), window)
