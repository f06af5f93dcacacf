"""Half-hourly and hourly geomagnetic index files: blank-separated text and JSON."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.functions.numbers import bare_text, drop_sentinels, to_number
from sunloom.functions.stages import computed_once
from sunloom.functions.times import fractional_hour, fractional_hour_timestamp, parse_datetime


@dataclass(frozen=True)
class IndexSpec:
    table: str
    hp: str
    ap: str
    fill: float = -1.0

    @property
    def raw_names(self) -> tuple[str, ...]:
        # The ten text columns in file order.
        return (
            "Year", "Month", "Day", "hh_start", "hh_mid", "days_start", "days_mid", self.hp, self.ap, "D",
        )


HP30 = IndexSpec("hpo_hp30", "Hp30", "ap30")
HP60 = IndexSpec("hpo_hp60", "Hp60", "ap60")


def parse_index_text(lines: DataFrame, spec: IndexSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of ``value`` text; ``#`` starts a comment anywhere in a line."""
    bare = lines.select(*keep, bare_text(F.regexp_replace("value", "#.*$", "")).alias("value"))
    parts = bare.where(F.col("value") != "").select(*keep, F.split("value", r"\s+").alias("part"))
    place = {name: i for i, name in enumerate(spec.raw_names)}

    used = ("Year", "Month", "Day", "hh_start", spec.hp, spec.ap)
    texts = computed_once(parts, {n: F.get("part", F.lit(place[n])) for n in used})
    values = texts.select(*keep, *[to_number(F.col(n)).alias(n) for n in used])
    numbers = values.select(
        *keep,
        *[F.col(n).alias(n.lower()) for n in used[:4]],
        *[drop_sentinels(F.col(n), (spec.fill,)).alias(n) for n in used[4:]],
    )
    when = fractional_hour_timestamp(F.col("year"), F.col("month"), F.col("day"), F.col("hh_start"))
    return numbers.select(*keep, when.alias("datetime"), "year", "month", "day", "hh_start", spec.hp, spec.ap)


def document_schema(value_name: str) -> T.StructType:
    """One JSON document: two parallel arrays."""
    return T.StructType(
        [
            T.StructField("datetime", T.ArrayType(T.StringType())),
            T.StructField(value_name, T.ArrayType(T.DoubleType())),
        ]
    )


def read_index_json(spark, path: str, value_name: str, one_per_file: bool = True) -> DataFrame:
    return spark.read.schema(document_schema(value_name)).option("multiLine", one_per_file).json(path)


def unnest_document(documents: DataFrame, value_name: str) -> DataFrame:
    """Parallel arrays to one row per time."""
    pairs = documents.select(F.inline(F.arrays_zip("datetime", value_name)))
    timed = computed_once(pairs, {"_when": parse_datetime(F.col("datetime"))})
    return timed.select(F.col("_when").alias("datetime"), F.col(value_name).cast("double"))


def merge_index_documents(hp_documents: DataFrame, ap_documents: DataFrame, spec: IndexSpec) -> DataFrame:
    """Outer merge of the two index series on their times."""
    # Entries without a readable time match nothing; a number of their own keeps them from
    # meeting in one task.
    apart = F.when(F.col("datetime").isNull(), F.monotonically_increasing_id()).otherwise(-1)
    hp, ap = (
        unnest_document(documents, name).withColumn("_apart", apart)
        for documents, name in ((hp_documents, spec.hp), (ap_documents, spec.ap))
    )
    merged = hp.join(ap, ["datetime", "_apart"], "full")
    when = F.col("datetime")
    return merged.select(
        when,
        F.year(when).alias("year"),
        F.month(when).alias("month"),
        F.day(when).alias("day"),
        fractional_hour(when).alias("hh_start"),
        drop_sentinels(F.col(spec.hp), (spec.fill,)).alias(spec.hp),
        drop_sentinels(F.col(spec.ap), (spec.fill,)).alias(spec.ap),
    )
