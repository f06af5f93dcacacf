"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

STATIC_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Column expressions are built much faster without a call site for each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

RUNTIME_SETTINGS = {
    # All stored times are zone-less UTC.
    "spark.sql.session.timeZone": "UTC",
    # A written year replaces that year only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A generated method above this size is never compiled to machine code; the wide
    # record projections are faster as separate operators.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Split a hot join key even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# The setting that bounds the tasks of a listing, and what it is if nobody set it.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_DEFAULT = 10_000

# Shares a shuffle is cut into before small ones are joined, and the size they are joined up to.
SHARES, SHUFFLE_SHARES = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", 600
SHARE_SIZE, SHARE_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "8m"


def build_session(app: str = "sunloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**STATIC_SETTINGS, **RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return _bound_shares(_bound_listing(builder.getOrCreate()))


def _bound_listing(spark: SparkSession) -> SparkSession:
    """Files are listed in a few rounds of tasks; without a bound each path is a task of its own."""
    if int(spark.conf.get(LISTING_TASKS, str(LISTING_DEFAULT))) == LISTING_DEFAULT:
        spark.conf.set(LISTING_TASKS, str(8 * spark.sparkContext.defaultParallelism))
    return spark


def _bound_shares(spark: SparkSession) -> SparkSession:
    """A task takes a share of a shuffle of bounded size: a larger table has more tasks, not larger ones."""
    most = max(SHUFFLE_SHARES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for key, value in {SHARES: str(most), SHARE_SIZE: SHARE_BYTES}.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings the operators rely on in a session made elsewhere."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return _bound_shares(_bound_listing(spark))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    # local-cluster[...] has executors of their own, so only local[...] may fall back.
    if not (context.master == "local" or context.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="sunloom-"))
    return context.getCheckpointDir().rstrip("/")


def _scratch_root(spark: SparkSession) -> str:
    return os.path.join(shared_folder(spark), "sunloom", spark.sparkContext.applicationId)


# Paths handed out inside the current scope, if there is one.
_SCOPE: ContextVar[list[str] | None] = ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = os.path.join(_scratch_root(spark), f"{name}-{uuid.uuid4().hex}")
    held = _SCOPE.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediate tables made inside, once their work is done.

    For steps that repeat without end, such as the batches of a stream.
    """
    token = _SCOPE.set([])
    try:
        yield
    finally:
        for path in _SCOPE.get():
            _remove(spark, path)
        _SCOPE.reset(token)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder.

    The table outlives any executor, and later readers prune its columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def part_files(spark: SparkSession, path: str) -> list[str]:
    """The part files of an intermediate table, without those that lie in folders."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    held = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return sorted(s.getPath().toString() for s in held if s.getPath().getName().startswith("part-"))


def drop_scratch(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application, once nothing reads them."""
    _remove(spark, _scratch_root(spark))


def _remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
