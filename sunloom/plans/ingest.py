"""Ingest jobs: text and JSON files into the stored series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunloom.functions.times import base_name
from sunloom.operators.quality import run_totals
from sunloom.sinks.tables import InsertCounts, insert_ignore, replace_years
from sunloom.session import materialise
from sunloom.sources.fixed_width import LINE_ORDER, parse_fixed_width, read_lines
from sunloom.sources.goes import INSTRUMENT_TABLES, normaliser
from sunloom.sources.hpo import IndexSpec, merge_index_documents, parse_index_text, read_index_json
from sunloom.sources.layouts import RecordLayout
from sunloom.tables import TABLES


def ingest_solar_wind(spark: SparkSession, path: str | list[str], layout: RecordLayout, root: str) -> DataFrame:
    """Fixed-width files of any number of years; each year replaces itself.

    Of lines with one time the first stays. Returns the rows refused, for a repeated
    or a missing timestamp.
    """
    rows = parse_fixed_width(read_lines(spark, path), layout, keep=LINE_ORDER)
    return replace_years(rows, TABLES[layout.table], root, LINE_ORDER)


def ingest_index_years(
    spark: SparkSession, hp_path: str, ap_path: str, spec: IndexSpec, root: str, one_per_file: bool = True
) -> DataFrame:
    hp = read_index_json(spark, hp_path, spec.hp, one_per_file)
    ap = read_index_json(spark, ap_path, spec.ap, one_per_file)
    return replace_years(merge_index_documents(hp, ap, spec), TABLES[spec.table], root)


def ingest_nowcast(lines: DataFrame, spec: IndexSpec, root: str) -> InsertCounts:
    """Rolling text; only times not yet stored are added."""
    rows = parse_index_text(lines, spec, keep=LINE_ORDER)
    return insert_ignore(rows, TABLES[spec.table], root, LINE_ORDER)


def register_satellite(files: DataFrame, instrument: str, root: str) -> tuple[InsertCounts, DataFrame]:
    """Decoded files of one instrument into its table, with totals per satellite.

    Files come in the order of satellite and name, rows in the order of the file;
    a time already stored, or met earlier, is left alone.
    """
    rows = normaliser(instrument)(files).withColumn("name", base_name(F.col("path")))
    staged = materialise(rows, "decoded")
    counts = insert_ignore(staged, TABLES[INSTRUMENT_TABLES[instrument]], root, ("name", "path", "step"))
    return counts, file_totals(files, staged)


def file_totals(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Files, parsed, failed and rows per satellite and in all; no rows means failed."""
    per_file = rows.groupBy("path").agg(F.count("*").alias("rows"))
    seen = files.select("satellite", "path").join(per_file, "path", "left")
    return run_totals(seen.withColumn("parsed", F.col("rows").isNotNull()), "satellite")
