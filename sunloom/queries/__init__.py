"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sunloom.queries import analytic, catalog, ingest, registered, satellites, storage, streams

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (analytic, catalog, ingest, satellites, registered, storage, streams)

QUERIES: dict[str, Query] = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
