"""Stored tables: replace by year, append, insert-or-ignore, rewrite."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom import versions
from sunloom.functions.names import child
from sunloom.functions.times import ntz
from sunloom.operators.inserts import accept_in_order, first_per_key, without_known
from sunloom.operators.reconcile import absent, present
from sunloom.session import materialise
from sunloom.sinks.paths import index_path, known_values, write_index
from sunloom.tables import (
    TableSpec,
    conform,
    ensure_tables,
    read_table,
    split_unkeyed,
    stored_schema,
    table_exists,
    table_path,
    with_partition,
)
from sunloom.versions import Conflict, Part, Version


# Share of the rows that must have keys of their own if a batch is not combined before its shuffle.
OWN_KEYS = 0.9


def _write(df: DataFrame, spec: TableSpec, root: str, first: Sequence[str] = ()) -> list[Part]:
    """One sorted run of files per year folder, not yet part of any version.

    A year may be any share of the data, so rows are spread by range of the key
    and not by year; every file then covers a narrow range of times. Finding the
    ranges reads the keys once before, so ``df`` should be stored already. With ``first``
    only the first row of each key in that order is written; the ranges keep the rows of a
    key together, so that takes no shuffle of its own.
    """
    path, schema = table_path(root, spec.name), stored_schema(spec)
    order = [spec.partition, *[c for c in spec.key if c != spec.partition]]
    dated = with_partition(df, spec)
    if first:
        # A stored year need not follow from the key, so it takes no part in the ranges.
        by = list(spec.key) if spec.partition in spec.columns else order
        ranged = first_per_key(dated.repartitionByRange(*by), by, first).select(*schema.fieldNames())
    else:
        ranged = dated.repartitionByRange(*order)
    added = versions.write_parts(ranged.sortWithinPartitions(*order), path, spec.partition)
    for unique in spec.unique:
        write_index(df.sparkSession, path, added, schema, unique)
    return added


def _latest(spark: SparkSession, spec: TableSpec, root: str) -> Version:
    return versions.latest(spark, table_path(root, spec.name)) or Version()


def _publish(spark: SparkSession, spec: TableSpec, root: str, base: Version, add: list[Part], drop=()) -> bool:
    """Whether the version after ``base`` is this one; if not, what was written is removed."""
    path = table_path(root, spec.name)
    try:
        versions.publish(spark, path, base, add, drop)
    except Conflict:
        versions.discard(spark, path, add)
        if spec.unique:
            versions.discard(spark, index_path(path), add)
        return False
    return True


DUPLICATE = "duplicate_key"


def _same_key(spec: TableSpec, other: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{other}{c}")) for c in spec.key])


def settle_keys(df: DataFrame, spec: TableSpec, order: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """One row for each key, the first in ``order``, and the rows refused with their ``error``.

    Refused are rows without a required column and all but the first of a key.
    Keys are counted with partial sums; rows of repeated keys alone are compared.
    """
    numbered = conform(df, spec, keep=order).withColumn("_row", F.monotonically_increasing_id())
    staged = materialise(numbered, spec.name)
    fit, unfit = split_unkeyed(staged, spec)
    firsts = fit.groupBy(*[F.col(c).alias(f"_of_{c}") for c in spec.key]).agg(
        F.count("*").alias("_n"), F.min(F.struct(*order, "_row")).alias("_first")
    )
    repeated = materialise(firsts.where("_n > 1").select("*", F.col("_first._row").alias("_kept")).drop("_first"), "repeated")
    dropped = [*[c for c in order if c not in spec.columns], "_row"]
    if repeated.isEmpty():
        return fit.drop(*dropped), unfit.drop(*dropped)
    losers = fit.join(repeated, _same_key(spec, "_of_"), "left_semi").join(
        repeated.select(F.col("_kept").alias("_row")), "_row", "left_anti"
    )
    losers = losers.select(*fit.columns, F.lit(DUPLICATE).alias("error"))
    kept = fit.join(losers.select("_row"), "_row", "left_anti").select(*fit.columns)
    return kept.drop(*dropped), unfit.unionByName(losers).drop(*dropped)


def replace_years(df: DataFrame, spec: TableSpec, root: str, order: Sequence[str] = ()) -> DataFrame:
    """Replace the years present in ``df``, in one commit; other years stay.

    Returns the rows refused: those without a required column, in practice the
    timestamp, and those whose key an earlier row has.
    """
    spark = df.sparkSession
    kept, refused = settle_keys(df, spec, order)
    while True:
        base = _latest(spark, spec, root)
        added = _write(kept, spec, root)
        years = {year for _, year in added}
        if _publish(spark, spec, root, base, added, [p for p in base.parts if p[1] in years]):
            return refused


def append_rows(df: DataFrame, spec: TableSpec, root: str, order: Sequence[str] = ()) -> DataFrame:
    """Append the rows of new keys; returns the others, with what ``replace_years`` refuses."""
    spark = df.sparkSession
    kept, refused = settle_keys(df, spec, order)
    while True:
        base = _latest(spark, spec, root)
        fresh, barred = kept, refused
        if base.parts:
            held = read_table(spark, root, spec, base).select(*[F.col(c).alias(f"_of_{c}") for c in spec.key])
            known = kept.join(held, _same_key(spec, "_of_"), "left_semi").withColumn("error", F.lit(DUPLICATE))
            barred = refused.unionByName(known)
            fresh = materialise(without_known(kept, held.toDF(*spec.key), spec.key), "fresh")
        if _publish(spark, spec, root, base, _write(fresh, spec, root)):
            return barred


@dataclass(frozen=True)
class InsertCounts:
    """Rows with a key that were offered and inserted, and the rows refused for lack of one."""

    offered: int
    inserted: int
    refused: int = 0
    refused_rows: DataFrame | None = field(default=None, compare=False, repr=False)

    @property
    def ignored(self) -> int:
        return self.offered - self.inserted


def new_rows(
    batch: DataFrame,
    known: DataFrame,
    spec: TableSpec,
    ordinal: Sequence[str],
    known_values: DataFrame | None = None,
) -> DataFrame:
    """The rows of ``batch`` an insert-or-ignore would add to the ``known`` ones.

    ``ordinal`` gives the row order of the batch; rows already stored win, then
    the first of the batch. With a unique column (``file_path``) both the key and
    that column must be free, and the order is one column of distinct values;
    ``known_values`` has the stored values of that column if ``known`` does not
    hold them all.
    """
    if not spec.unique:
        return without_known(first_per_key(batch, spec.key, ordinal), known, spec.key)
    (unique,) = spec.unique
    (place,) = ordinal
    free = without_known(without_known(batch, known, spec.key), known if known_values is None else known_values, [unique])
    return accept_in_order(free, spec.key, unique, place)


def insert_ignore(batch: DataFrame, spec: TableSpec, root: str, ordinal: Sequence[str]) -> InsertCounts:
    """Insert the rows whose key (and unique column) are free; count what went in.

    Rows without a required column are counted and returned, not inserted.

    Only the stored rows inside the batch's time range are compared by key, and paths
    with those of the index buckets the batch hits. If another writer was faster, the
    batch is compared with its rows too, so no key is stored twice.
    """
    spark = batch.sparkSession
    # Columns the table lacks stay with the batch, so refused rows can be told.
    extra = [c for c in batch.columns if c.lower() not in spec.columns and c not in ordinal]
    whole = materialise(conform(batch, spec, keep=[*ordinal, *[c.lower() for c in extra if c.lower() != "error"]]), "batch")
    staged, unfit = split_unkeyed(whole, spec)
    refused = unfit.count()
    lo, hi, offered, n_keys = staged.agg(
        F.min("datetime"), F.max("datetime"), F.count("*"), F.approx_count_distinct(F.xxhash64(*spec.key))
    ).first()
    if not offered:
        return InsertCounts(0, 0, refused, unfit)
    ensure_tables(spark, root, [spec])
    path = table_path(root, spec.name)
    while True:
        base = _latest(spark, spec, root)
        if not (base.parts or spec.unique) and n_keys >= OWN_KEYS * offered:
            added = _write(staged, spec, root, ordinal)
            inserted = versions.read_parts(spark, path, added, stored_schema(spec)).count()
            if _publish(spark, spec, root, base, added):
                return InsertCounts(offered, inserted, refused, unfit)
            continue
        near = read_table(spark, root, spec, base).where(F.col("datetime").between(ntz(lo), ntz(hi)))
        if spec.partition not in spec.columns:  # the folder is the year of the timestamp
            near = near.where(F.col(spec.partition).between(lo.year, hi.year))
        values = known_values(spark, path, base, staged, *spec.unique) if spec.unique else None
        found = new_rows(staged, near.select(*spec.key), spec, ordinal, values)
        fresh = materialise(found.select(*spec.columns), "fresh")
        inserted = fresh.count()
        if not inserted or _publish(spark, spec, root, base, _write(fresh, spec, root)):
            return InsertCounts(offered, inserted, refused, unfit)


def surviving_rows(catalog: DataFrame, listing: DataFrame, column: str = "file_path", path: str = "path") -> DataFrame:
    """Catalogue rows whose file is still listed."""
    return present(catalog, listing.select(F.col(path).alias(column)), column).select(*catalog.columns)


def orphan_rows(catalog: DataFrame, listing: DataFrame, column: str = "file_path", path: str = "path") -> DataFrame:
    """Catalogue rows whose file is gone."""
    return absent(catalog, listing.select(F.col(path).alias(column)), column).select(*catalog.columns)


def delete_orphans(
    spark: SparkSession, spec: TableSpec, root: str, listing: DataFrame, column: str = "file_path"
) -> int:
    """Delete the rows whose file is gone, in place; returns how many went.

    Only the parts that hold orphans are written anew, and the next version names these
    instead. Readers of the version before go on reading it.
    """
    path, schema = table_path(root, spec.name), stored_schema(spec)
    tagged = T.StructType([*schema.fields, T.StructField("commit", T.StringType())])
    while True:
        base = _latest(spark, spec, root)
        rows = versions.read_parts(spark, path, base.parts, tagged)
        gone = materialise(orphan_rows(rows, listing, column).select("commit", spec.partition), "orphans")
        counts = gone.groupBy("commit", spec.partition).count().collect()
        hit = [(r["commit"], f"{spec.partition}={r[spec.partition]}") for r in counts]
        if not hit:
            return 0
        kept = surviving_rows(versions.read_parts(spark, path, hit, schema), listing, column)
        if _publish(spark, spec, root, base, _write(materialise(kept, "kept"), spec, root), hit):
            return sum(r["count"] for r in counts)


def compact(spark: SparkSession, spec: TableSpec, root: str, most: int = 8) -> int:
    """Write the years of more than ``most`` parts as one part each; returns how many years.

    Every insert adds a part to each year it touches, and to the index of paths.
    """
    path, schema = table_path(root, spec.name), stored_schema(spec)
    while True:
        base = _latest(spark, spec, root)
        years = Counter(year for _, year in base.parts)
        many = [p for p in base.parts if years[p[1]] > most]
        if not many:
            return 0
        rows = versions.read_parts(spark, path, many, schema)
        if _publish(spark, spec, root, base, _write(rows, spec, root), many):
            return len({year for _, year in many})


def quarantine(classified: DataFrame, root: str, error: str = "error", path: str = "path") -> None:
    """Refused records below ``root``, one folder per error class, each path once.

    Of several errors of a path the first by name stays. Paths already set aside are left as they are, so a run may be repeated.
    """
    spark = classified.sparkSession
    bad = first_per_key(classified.where(F.col(error).isNotNull()), [path], [error])
    if table_exists(spark, root):
        # The folder may be there without rows, after a run that refused nothing.
        held = spark.read.schema(bad.schema).parquet(root).select(path)
        bad = materialise(without_known(bad, held, [path]), "refused")
    bad.write.mode("append").partitionBy(error).parquet(root)


def with_target_path(valid: DataFrame, folder, path: str = "path", name: str = "file_path") -> DataFrame:
    """Where a valid file belongs: its dated folder and its own name."""
    return valid.withColumn(name, child(folder, F.col(path)))
