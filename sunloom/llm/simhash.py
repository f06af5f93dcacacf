"""Near-duplicates by SimHash with pigeonring filtering.

A fingerprint is the bitwise majority of the XXH64 values of a text's shingles. Two
fingerprints link at ``DISTANCE`` or fewer differing bits. The 64 bits form a ring of
segments; if all differences sum to ``DISTANCE``, some start on the ring exists from which
every chain of k segments differs in at most ``k * DISTANCE / segments`` bits. Here that is
no bit in one segment, one in two, two in three and three in four: the first two lengths
are the key of an equi-join (a probe for each bit the second segment may differ in), the
longer chains prune inside the join, and the full distance decides last.

Copies share a fingerprint and are one class, so links join classes only; their components
come from alternating star contractions, with a written table between rounds.

Results in odd cases: a text without words has fingerprint zero and links like any other;
fewer words than a shingle are one shingle; repeated rows get a row each; a row without
doc_id takes part, but a component is named by its least doc_id and by null only if it has
none; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.llm.common import BLANK_TABLE, slices

SEED = 42
SHINGLE = 4
DISTANCE = 4
WIDTHS = (13, 13, 13, 13, 12)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint as an unsigned integer."""
    words = text.encode().translate(BLANK_TABLE).split(b" ") if text else []
    words = [w for w in words if w]
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        return digest(b" ".join(words), SEED)
    shifted = (words[k:] for k in range(shingle))
    hashes = np.array([digest(s, SEED) for s in map(b" ".join, zip(*shifted))], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(">u8")[0])


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a signed long."""
    source = documents.select("doc_id", "text")
    target = T.StructType([source.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches):
        for batch in slices(batches):
            values = [simhash(t, shingle) for t in batch.column("text").to_pylist()]
            bits = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), bits], names=["doc_id", "fp"])

    return source.mapInArrow(run, target)


def _segments(widths: tuple[int, ...]) -> list[tuple[int, int]]:
    """(first bit, width) of each segment."""
    return [(sum(widths[:k]), w) for k, w in enumerate(widths)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _chain_mask(start: int, length: int, widths: tuple[int, ...]) -> int:
    ring = _segments(widths)
    return _signed(sum(((1 << w) - 1) << at for at, w in (ring[(start + k) % len(ring)] for k in range(length))))


def near_pairs(classes: DataFrame, distance: int = DISTANCE, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Pairs a < b of the distinct ``fp`` that differ in at most ``distance`` bits.

    Needs ``distance < segments <= 2 * distance``, so that a chain of one segment differs in
    no bit and a chain of two in one at most.
    """
    ring, m = _segments(widths), len(widths)
    assert sum(widths) == 64 and distance < m <= 2 * distance

    def part(k: int) -> str:
        at, w = ring[k % m]
        return f"(shiftrightunsigned(fp, {at}) & {(1 << w) - 1}L)"

    keys = ", ".join(f"({k}L << 40) | ({part(k)} << 20) | {part(k + 1)}" for k in range(m))
    index = classes.select("fp", F.expr(f"explode(array({keys}))").alias("key"))
    flips = F.array(*(F.lit(v).cast("long") for v in [0, *(1 << b for b in range(max(widths)))]))
    probes = index.select(F.col("fp").alias("a"), F.explode(flips).alias("flip"), "key").select(
        "a", F.col("key").bitwiseXOR(F.col("flip")).alias("key")
    )
    masks = {
        length: "array(" + ", ".join(f"{_chain_mask(k, length, widths)}L" for k in range(m)) + ")"
        for length in range(3, m)
    }
    chains = " AND ".join(
        f"bit_count((a ^ b) & {mask}[CAST(shiftright(p.key, 40) AS INT)]) <= {length * distance // m}"
        for length, mask in masks.items()
    )
    near = F.expr(f"p.key = q.key AND a < b AND {chains} AND bit_count(a ^ b) <= {distance}")
    # Sizes are estimated without what explode multiplies, so either side may look small
    # enough to be broadcast through the driver.
    found = probes.alias("p").join(index.withColumnRenamed("fp", "b").alias("q").hint("merge"), near)
    return found.select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node reachable, for all nodes of the links (a, b)."""
    from sunloom.session import materialise

    edges = materialise(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    state = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select("v", "v").distinct()
            )
        state = seen
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(small.union(lower).distinct(), "edges")


def _rooted(marked: DataFrame, distance: int, widths: tuple[int, ...]) -> DataFrame:
    """fp, its least doc_id, and root, the least fp reachable over links."""
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_pairs(classes.select("fp"), distance, widths))
    return classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, widths: tuple[int, ...] = WIDTHS
) -> DataFrame:
    """doc_id, fp and component_id, the least doc_id reachable over links, for every row."""
    from sunloom.session import materialise

    # Texts are read once; later steps work on two longs a row.
    marked = materialise(fingerprints(documents, shingle), "fingerprints")
    rooted = _rooted(marked, distance, widths)
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(documents: DataFrame) -> DataFrame:
    """One row of each component, with the given columns.

    It is the row of the least doc_id, a missing one last; of several rows with that id
    the one of the least fingerprint, then of the least text. Rows of one id with unlike
    texts are of different components, and each of these keeps its own. Only rows whose id
    is missing or repeated are looked at again with their text.
    """
    from sunloom.session import materialise

    marked = materialise(fingerprints(documents), "fingerprints")
    rooted = _rooted(marked, DISTANCE, WIDTHS)
    first = F.min(F.struct(F.col("least").isNull().alias("_nameless"), "least", "fp")).alias("first")
    stays = materialise(
        rooted.groupBy("root").agg(first).select(F.col("first.least").alias("id"), F.col("first.fp").alias("fp")), "stays"
    )
    counts = marked.groupBy(F.col("doc_id").alias("id")).agg(F.count("*").alias("n"))
    shared = materialise(counts.where("n > 1 OR id IS NULL").select("id"), "shared-ids")
    rows = documents.alias("d")
    if shared.isEmpty():
        return rows.join(stays.alias("k"), F.expr("d.doc_id = k.id"), "left_semi")
    plain = stays.join(shared, "id", "left_anti").alias("k")
    plain = rows.join(plain, F.expr("d.doc_id = k.id"), "left_semi")
    columns = [F.col(f"`{c}`") for c in documents.columns]
    contested = rows.join(shared.alias("s"), F.expr("d.doc_id <=> s.id"), "left_semi").select(
        "doc_id", "text", F.struct(*columns).alias("_row")
    )
    source = contested.select("doc_id", "text", "_row")
    target = T.StructType([source.schema["doc_id"], source.schema["_row"], T.StructField("_fp", T.LongType())])

    def run(batches):
        for batch in slices(batches):
            values = [simhash(t) for t in batch.column("text").to_pylist()]
            bits = pa.array(np.array(values, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_row"), bits], names=["doc_id", "_row", "_fp"]
            )

    settled = (
        source.mapInArrow(run, target)
        .join(stays, F.expr("doc_id <=> id AND _fp = fp"), "left_semi")
        .groupBy("doc_id", "_fp")
        .agg(F.min_by("_row", F.struct(F.xxhash64("_row.text"), F.col("_row.text"))).alias("_row"))
        .select("_row.*")
    )
    return plain.union(settled)
