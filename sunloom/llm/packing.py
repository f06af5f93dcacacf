"""Best-fit packing of tokenised documents by exact-complement hashing.

Lengths are at most the sequence length, so a plan over the counts of each length is
bounded whatever the corpus: single, pair and triple sums of available lengths that fill a
gap exactly are consumed first, as often as the counts allow, and what remains goes best
fit. The plan's patterns then meet the pieces by the rank of a piece among those of its
length; ranks come from per-task counts, so no length is gathered in one place.

Results in odd cases: a null or empty text is the end token alone; repeated rows and
repeated or null ids are packed row by row; a document longer than a sequence is cut into
full pieces, the first of which may be shorter; an empty table has no pieces; other columns
are not read.
"""

from __future__ import annotations

import base64
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import slices, tokenizer_file

SEQUENCE = 2048
END = 0
# Letters that every version of the character tables agrees on.
COMMON = 0x250


def byte_encoder(name: str = "byte_bpe_50k"):
    """text -> numpy uint32 ids, as the vocabulary's own library gives them.

    The same merges as ranks are several times faster; texts with characters on which
    character tables may differ go through the library itself.
    """
    import re

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(tokenizer_file(f"{name}.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(tokenizer_file(f"{name}.json"))
    special = sorted(t.content for t in exact.get_added_tokens_decoder().values())
    uncommon = re.compile(f"[^\0-{chr(COMMON - 1)}]")

    def encode(text: str) -> np.ndarray:
        if any(s in text for s in special) or not text.isascii() and uncommon.search(text):
            return np.array(exact.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)

    return encode


PIECES = [
    T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("task", T.LongType()),
    T.StructField("nth", T.LongType()),
]


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` tokens; full ones but the first."""
    first = total % size or size
    bounds = [0, *range(first, total + 1, size)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def tokenised_pieces(documents: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Pieces of all documents with their place among the task's pieces of equal length."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = documents.select("doc_id", "text", F.spark_partition_id().cast("long").alias("_task"))
    schema = T.StructType([source.schema["doc_id"], *PIECES])
    arrow = to_arrow_schema(schema)

    def run(batches):
        encode = byte_encoder()
        seen: dict[int, int] = defaultdict(int)
        for batch in slices(batches):
            rows: list[int] = []
            out: list[tuple] = []
            tasks = batch.column("_task").to_pylist()
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(encode(text) if text else np.empty(0, "<u4"), np.uint32(END)).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), size)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    rows.append(row)
                    out.append((number, start, length, crc, tasks[row], seen[length]))
                    seen[length] += 1
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out), list(arrow)[1:])] if out else []
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows)), *columns], schema=arrow)

    return source.mapInArrow(run, schema)


def plan_patterns(counts: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences follow each; every piece is in one.

    The work depends on the number of different lengths, not on how many pieces there are.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    planned: list[tuple[tuple[int, ...], int]] = []

    def use(pattern: tuple[int, ...]) -> bool:
        need: dict[int, int] = defaultdict(int)
        for n in pattern:
            need[n] += 1
        times = min(left.get(n, 0) // k for n, k in need.items())
        if times:
            planned.append((pattern, times))
            for n, k in need.items():
                left[n] -= k * times
                if not left[n]:
                    del left[n]
        return bool(times)

    use((size,))
    # Longest first: they have the fewest complements.
    for longest in sorted(left, reverse=True):
        gap = size - longest
        if longest in left and gap in left:
            use((longest, gap))
        if longest in left:
            for a in sorted((n for n in left if gap / 2 <= n < gap), reverse=True):
                if longest not in left:
                    break
                if a in left and gap - a in left:
                    use((longest, a, gap - a))
        if longest in left and gap >= 3:
            _triples(longest, gap, left, use)
    planned.extend(_best_fit(left, size))
    return planned


def _triples(longest: int, gap: int, left: dict[int, int], use) -> None:
    """Fill ``gap`` exactly with three lengths, looking up the third by what is missing."""
    usable = sorted((n for n in left if n <= gap - 2), reverse=True)
    for a in usable:
        if a * 3 < gap:
            return
        if a not in left:
            continue
        rest = gap - a
        for b in usable:
            if b > a or b >= rest:
                continue
            if b * 2 < rest:
                break
            if longest not in left:
                return
            if a not in left:
                break
            if b in left and rest - b in left:
                use((longest, a, b, rest - b))


def _best_fit(left: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on groups of equally filled sequences."""
    groups: dict[int, list[list]] = {}
    gaps: list[int] = []

    def add(gap: int, pattern: tuple[int, ...], times: int) -> None:
        if gap not in groups:
            groups[gap] = []
            insort(gaps, gap)
        groups[gap].append([pattern, times])

    for n in sorted(left, reverse=True):
        todo = left[n]
        while todo:
            at = bisect_left(gaps, n)
            if at == len(gaps):
                fit = size // n
                full, part = divmod(todo, fit)
                if full:
                    add(size - n * fit, (n,) * fit, full)
                if part:
                    add(size - n * part, (n,) * part, 1)
                break
            gap = gaps[at]
            pattern, times = groups[gap][-1]
            fit = min(gap // n, todo)
            bins = min(times, todo // fit)
            groups[gap][-1][1] -= bins
            if not groups[gap][-1][1]:
                groups[gap].pop()
                if not groups[gap]:
                    del groups[gap]
                    gaps.pop(at)
            add(gap - fit * n, pattern + (n,) * fit, bins)
            todo -= fit * bins
    return [(tuple(p), times) for held in groups.values() for p, times in held]


def plan_slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, dict[str, np.ndarray]]:
    """For each length, in order of rank: first rank, first sequence and place of each run."""
    slots: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for n in pattern:
            slots[n].append((taken[n], sequence, offset))
            taken[n] += times
            offset += n
        sequence += times
    return {
        n: dict(zip(("rank", "sequence", "offset"), np.array(runs, dtype=np.int64).T)) for n, runs in slots.items()
    }


def pack(documents: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    from sunloom.session import materialise

    # Tokenised once; the written rows fix each piece's place in its task.
    pieces = materialise(tokenised_pieces(documents, size), "pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    # At most `size` rows, one for each length.
    counts = {r.length: r.n for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = documents.sparkSession.sparkContext.broadcast(plan_slots(plan_patterns(counts, size)))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("_rank")
    )
    target = T.StructType(
        [
            *(ranked.schema[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    def place(batches):
        plan = slots.value
        for batch in batches:
            ranks, lengths = (batch.column(c).to_numpy() for c in ("_rank", "length"))
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for n in np.unique(lengths):
                here = lengths == n
                runs = plan[int(n)]
                run = np.searchsorted(runs["rank"], ranks[here], side="right") - 1
                sequence[here] = runs["sequence"][run] + ranks[here] - runs["rank"][run]
                offset[here] = runs["offset"][run]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, target)
