"""One ledger of what became of each file.

A run adds one row for each file it saw: path, state, error class, place, run. The fate of
a file is that of its latest run, so a file that turns valid leaves the quarantine without
any row being deleted, and the fates add up to the files seen. Runs are the parts of a
table of versions: a run told again replaces itself, and ``fold_runs`` keeps the latest
row of each file only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sunloom import versions
from sunloom.session import materialise

# States, the one that counts first where a run saw a path more than once.
REGISTERED, KNOWN, HELD, REFUSED = "registered", "known_key", "held", "refused"
STATES = (REGISTERED, KNOWN, HELD, REFUSED)

FATES = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("state", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("file_path", T.StringType()),
        T.StructField("run", T.LongType()),
    ]
)
_RUNS = "runs"


def _base(spark: SparkSession, root: str) -> versions.Version:
    return versions.latest(spark, root) or versions.Version()


def next_run(spark: SparkSession, root: str) -> int:
    return max((versions.span(p)[1] for p in _base(spark, root).parts), default=-1) + 1


def _rows(spark: SparkSession, root: str, base: versions.Version) -> DataFrame:
    paths = [f"{root}/commit={commit}/{part}" for commit, part in base.parts]
    return spark.read.schema(FATES).parquet(*paths) if paths else spark.createDataFrame([], FATES)


def _latest_rows(rows: DataFrame) -> DataFrame:
    """The row of the latest run of each path; copies combine before the shuffle."""
    rest = [c for c in FATES.fieldNames() if c not in ("path", "run")]
    latest = rows.groupBy("path").agg(F.max(F.struct("run", *rest)).alias("_row"))
    return latest.select(*[F.col(c) if c == "path" else F.col(f"_row.{c}").alias(c) for c in FATES.fieldNames()])


def record_run(fates: DataFrame, root: str, run: int) -> None:
    """Add the fates of one run: ``path``, ``state``, ``error``, ``file_path``.

    A path seen twice in a run has the first of its states in the order of ``STATES``; rows
    without a path are left out. Runs already folded together are not taken again.
    """
    spark = fates.sparkSession
    rank = F.array_position(F.array(*map(F.lit, STATES)), F.col("state"))
    told = fates.where(F.col("path").isNotNull()).groupBy("path")
    one = told.agg(F.min(F.struct(rank.alias("rank"), "state", "error", "file_path")).alias("_row"))
    rows = one.select(
        "path", "_row.state", "_row.error", "_row.file_path", F.lit(run).cast("long").alias("run")
    ).withColumn(_RUNS, F.lit(f"{run}-{run}"))
    rows = materialise(rows, "fates")
    while True:
        base = _base(spark, root)
        again = [p for p in base.parts if versions.span(p) == (run, run)]
        if not again and any(a <= run <= b for a, b in map(versions.span, base.parts)):
            raise ValueError(f"run {run} is part of folded runs")
        parts = versions.write_parts(rows, root, _RUNS)
        try:
            versions.publish(spark, root, base, parts, again)
            return
        except versions.Conflict:
            versions.discard(spark, root, parts)


def file_fates(spark: SparkSession, root: str) -> DataFrame:
    """Every file ever seen with its latest fate."""
    return _latest_rows(_rows(spark, root, _base(spark, root)))


def quarantined(spark: SparkSession, root: str) -> DataFrame:
    """Files whose latest run refused them."""
    return file_fates(spark, root).where(F.col("state") == REFUSED)


def fate_counts(spark: SparkSession, root: str, run: int | None = None) -> DataFrame:
    """Files by state and error class, at present or as one unfolded run told them."""
    rows = _rows(spark, root, _base(spark, root)) if run is not None else file_fates(spark, root)
    rows = rows.where(F.col("run") == run) if run is not None else rows
    return rows.groupBy("state", "error").agg(F.count("*").alias("n"))


def fold_runs(spark: SparkSession, root: str) -> int:
    """Keep the latest row of each file only; returns how many parts were folded."""
    while True:
        base = _base(spark, root)
        if len(base.parts) < 2:
            return 0
        spans = [versions.span(p) for p in base.parts]
        name = f"{min(s[0] for s in spans)}-{max(s[1] for s in spans)}"
        rows = _latest_rows(_rows(spark, root, base)).withColumn(_RUNS, F.lit(name))
        parts = versions.write_parts(rows, root, _RUNS)
        try:
            versions.publish(spark, root, base, parts, base.parts)
            return len(base.parts)
        except versions.Conflict:
            versions.discard(spark, root, parts)
