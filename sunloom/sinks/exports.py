"""Exports to Parquet, CSV and JSON."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom.functions.times import ntz
from sunloom.tables import SW30_COLUMNS, TABLES, read_table

# Stored table, export name, order.
CSV_EXPORTS = (
    ("omni_high_resolution", "omni_1min", ("datetime",)),
    ("omni_high_resolution_5min", "omni_5min", ("datetime",)),
    ("omni_low_resolution", "omni_1hour", ("datetime",)),
    ("goes_xrs", "goes_xrs", ("satellite", "datetime")),
    ("goes_mag", "goes_mag", ("satellite", "datetime")),
    ("goes_proton", "goes_proton", ("satellite", "datetime")),
)


def in_dates(df: DataFrame, start: date | None = None, end: date | None = None, when: str = "datetime") -> DataFrame:
    """Optional bounds; the end date runs to 23:59:59."""
    if start is not None:
        df = df.where(F.col(when) >= ntz(datetime.combine(start, time.min)))
    if end is not None:
        df = df.where(F.col(when) <= ntz(datetime.combine(end, time(23, 59, 59))))
    return df


def export_parquet(
    df: DataFrame, path: str, start: date | None = None, end: date | None = None, columns: Sequence[str] = SW30_COLUMNS
) -> None:
    """The named columns in time order: file by file and inside each file."""
    chosen = in_dates(df, start, end).select(*columns)
    chosen.repartitionByRange("datetime").sortWithinPartitions("datetime").write.mode("overwrite").parquet(path)


def csv_text(df: DataFrame) -> DataFrame:
    """Timestamps to the microsecond with a blank between date and clock, booleans as t and f."""
    out = []
    for f in df.schema.fields:
        value = F.col(f.name)
        if isinstance(f.dataType, T.TimestampNTZType):
            value = value.cast("string")
        elif isinstance(f.dataType, T.BooleanType):
            value = F.when(value, "t").when(~value, "f")
        out.append(value.alias(f.name))
    return df.select(*out)


def export_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Ordered CSV part files with a header each; NULL is an empty field."""
    csv_text(df.orderBy(*order)).write.mode("overwrite").option("header", "true").csv(path)


def export_tables(
    spark: SparkSession, root: str, out: str, names: Sequence[str] | None = None
) -> dict[str, str | None]:
    """One CSV folder per table, picked by stored or export name.

    A table that fails does not stop the others; the result maps each export name
    to its error, None if it went well.
    """
    outcome: dict[str, str | None] = {}
    for stored, exported, order in CSV_EXPORTS:
        if names is not None and not {stored, exported} & set(names):
            continue
        try:
            spec = TABLES[stored]
            export_csv(read_table(spark, root, spec).select(*spec.columns), f"{out}/{exported}", order)
            outcome[exported] = None
        except Exception as failure:  # noqa: BLE001 - reported per table
            outcome[exported] = str(failure)
    return outcome


def export_events(windows: DataFrame, path: str, event: str = "reference_time") -> None:
    """One folder of CSV per event, named by its reference time."""
    tagged = windows.withColumn("event_id", F.date_format(event, "yyyyMMddHHmmss")).drop(event)
    spread = tagged.repartitionByRange("event_id", "datetime").sortWithinPartitions("event_id", "datetime")
    csv_text(spread).write.mode("overwrite").option("header", "true").partitionBy("event_id").csv(path)


def export_index(samples: DataFrame, path: str, phase: str = "phase") -> None:
    """One folder of CSV per split with ``datetime`` and ``label``."""
    rows = samples.select("datetime", "label", phase)
    spread = rows.repartitionByRange(phase, "datetime").sortWithinPartitions(phase, "datetime")
    csv_text(spread).write.mode("overwrite").option("header", "true").partitionBy(phase).csv(path)


REQUEST = ("query_time", "target_time", "time_range", "telescope")


def manifest_documents(files: DataFrame, by: Sequence[str] = REQUEST) -> DataFrame:
    """Nested documents, one for each request and channel: request to channel to files.

    A row without a file name is a channel searched in vain; it shows as an empty
    list. A request without any file gives no document. The reader takes the
    documents of a request together.
    """
    found = F.col("filename").isNotNull()
    file = F.when(found, F.struct("url", "filename"))
    per_channel = files.groupBy(*by, "channel").agg(F.array_sort(F.collect_list(file)).alias("files"))
    documents = per_channel.select(*by, F.create_map("channel", F.struct("files")).alias("channels"))
    wanted = files.where(found).select(*[F.col(c).alias(f"_of_{c}") for c in by]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in by])
    return documents.join(wanted, same, "left_semi")


def write_manifests(documents: DataFrame, path: str) -> None:
    documents.write.mode("append").json(path)
