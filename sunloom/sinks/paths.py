"""Index of stored paths: which values of a unique column a table holds.

Beside a table lies ``<table>_paths``, a commit for each commit of the table, with the
values by bucket of their folder and sorted. Files arrive by day and instrument and these
are folders, so a batch hits few buckets; an insert reads those alone, and of them the row
groups between its least and greatest path. Entries of parts that a version has dropped
are passed over, so the index follows the versions of its table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.versions import Part, Version, read_parts

BUCKETS = 4096
_ENTRIES = T.StructType([T.StructField("value", T.StringType()), T.StructField("part", T.StringType())])


def index_path(table: str) -> str:
    return f"{table}_paths"


def bucket_of(path: Column) -> Column:
    folder = F.regexp_replace(path, "[^/]*$", "")
    return F.pmod(F.xxhash64(folder), F.lit(BUCKETS)).cast("int")


def write_index(spark: SparkSession, table: str, added: list[Part], schema: T.StructType, unique: str) -> None:
    """Index the rows of parts just written; before they are published.

    Large folders are spread over tasks by path, so a bucket may have several files.
    """
    if not added:
        return
    rows = read_parts(spark, table, added, schema)
    partition = schema.fieldNames()[-1]
    entries = rows.where(F.col(unique).isNotNull()).select(
        F.col(unique).alias("value"),
        F.concat(F.lit(f"{partition}="), F.col(partition).cast("string")).alias("part"),
        bucket_of(F.col(unique)).alias("bucket"),
    )
    ranged = entries.repartitionByRange("bucket", "value").sortWithinPartitions("bucket", "value")
    (commit,) = {commit for commit, _ in added}
    ranged.write.partitionBy("bucket").parquet(f"{index_path(table)}/commit={commit}")


def known_values(spark: SparkSession, table: str, version: Version, batch: DataFrame, unique: str) -> DataFrame:
    """Stored values that may meet those of ``batch``: all in the buckets it hits.

    The driver gets the numbers of these buckets, at most ``BUCKETS``.
    """
    bucket = bucket_of(F.col(unique))
    hit = [r[0] for r in batch.where(F.col(unique).isNotNull()).select(bucket).distinct().collect()]
    if not hit or not version.parts:
        return spark.createDataFrame([], T.StructType([T.StructField(unique, T.StringType())]))
    least, greatest = batch.agg(F.min(unique), F.max(unique)).first()
    fields = [*_ENTRIES.fields, T.StructField("commit", T.StringType()), T.StructField("bucket", T.IntegerType())]
    entries = (
        spark.read.schema(T.StructType(fields))
        .option("basePath", index_path(table))
        .parquet(*[f"{index_path(table)}/commit={commit}" for commit in version.commits])
        .where(F.col("bucket").isin(hit) & F.col("value").between(least, greatest))
    )
    if version.dropped:
        gone = [f"{commit}/{part}" for commit, part in version.dropped]
        entries = entries.where(~F.concat_ws("/", "commit", "part").isin(gone))
    return entries.select(F.col("value").alias(unique))
