"""Sharding by extendible hashing.

A directory maps prefixes of a row's hash bits to shards. It starts as one shard; a shard
above the byte limit splits on its next bit, and only it, until every shard fits. So a
row's shard is the shortest prefix of its bits whose rows fit together. Sizes are summed
for prefixes of a bounded number of bits and rolled up; rows whose prefix does not fit even
then go on with further bits.

The bits are those of an MD5 of the id, then of one of the text, then of the row's number in
the scan, so even repeated rows part. A row above the limit by itself is a shard of its own.

Results in odd cases: null ids and texts hash as empty strings and a null text has zero bytes;
an empty table has no shards; other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMIT_BYTES = 1 << 20
# Bits resolved in one round beyond those that even sharing would need.
MORE_BITS = 8
HASH_BITS = 60

_NIBBLES = {f"{v:x}": f"{v:04b}" for v in range(16)}


def _bits(value: Column) -> Column:
    """The first 60 bits of the MD5 as a string of 0 and 1."""
    digits = F.substring(F.md5(value.cast("binary")), 1, HASH_BITS // 4)
    return F.lpad(F.conv(digits, 16, 2), HASH_BITS, "0")


def hashed_rows(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the row's bits."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        "doc_id",
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.concat(
            _bits(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))),
            _bits(text),
            F.lpad(F.conv(F.monotonically_increasing_id().cast("string"), 10, 2), 64, "0"),
        ).alias("bits"),
    )


def shard(documents: DataFrame, limit_bytes: int = LIMIT_BYTES) -> DataFrame:
    """doc_id, n_bytes, shard (its bits as text), shard_bytes and shard_docs for every row."""
    from sunloom.session import materialise

    rows = materialise(hashed_rows(documents), "hashed")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    all_bits = 2 * HASH_BITS + 64
    done, known, shards = [], 0, None
    open_rows = rows
    while True:
        even = math.ceil(math.log2(max(1.0, total / limit_bytes))) if not known else 0
        depth = min(all_bits, known + even + MORE_BITS)
        prefix = F.substring("bits", 1, depth)
        fine = open_rows.groupBy(prefix.alias("prefix")).agg(
            F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")
        )
        fine = materialise(fine, "prefixes")
        levels = fine.select("*", F.explode(F.sequence(F.lit(known), F.lit(depth))).alias("level"))
        sized = levels.groupBy(F.substring("prefix", F.lit(1), F.col("level")).alias("shard"), "level").agg(
            F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs")
        )
        last = depth == all_bits
        fits = (F.col("shard_bytes") <= limit_bytes) | (F.col("shard_docs") == 1) | F.lit(last) & (F.col("level") == depth)
        fitting = materialise(sized.where(fits), "fitting")
        # No shard fits above this level, where few keys would take all prefixes.
        first = fitting.agg(F.min("level")).first()[0]
        reached = levels.where(F.col("level") >= (depth if first is None else first))
        leaves = (
            reached.select("prefix", "level", F.substring("prefix", F.lit(1), F.col("level")).alias("shard"))
            .join(fitting, ["shard", "level"])
            .groupBy("prefix")
            .agg(F.min_by(F.struct("shard", "shard_bytes", "shard_docs"), "level").alias("leaf"))
        )
        leaves = materialise(leaves, "leaves")
        placed = open_rows.withColumn("prefix", prefix)
        done.append(placed.join(leaves, "prefix").select("doc_id", "n_bytes", "leaf.*"))
        if last or fine.join(leaves, "prefix", "left_anti").isEmpty():
            break
        open_rows = materialise(placed.join(leaves, "prefix", "left_anti").drop("prefix"), "open")
        known = depth
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return result


def write_shards(documents: DataFrame, sharded: DataFrame, path: str) -> None:
    """Write every row in one folder for each shard; rows of one id share a shard."""
    shards = sharded.select(F.col("doc_id").alias("_id_of_shard"), "shard").distinct()
    joined = documents.join(shards, F.col("doc_id").eqNullSafe(F.col("_id_of_shard"))).drop("_id_of_shard")
    joined.repartition("shard").write.partitionBy("shard").parquet(path)
