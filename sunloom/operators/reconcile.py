"""Catalogue against listing, wanted against held."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _names(others: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Each name once: copies combine before the shuffle, which the join then reuses."""
    return others.select(*([on] if isinstance(on, str) else on)).distinct()


def present(rows: DataFrame, others: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose name the other side also has."""
    return rows.join(_names(others, on), on, "left_semi")


def absent(rows: DataFrame, others: DataFrame, on: Sequence[str] | str) -> DataFrame:
    """Rows whose name the other side lacks."""
    return rows.join(_names(others, on), on, "left_anti")


def wanted_files(remote: DataFrame, held: DataFrame, on: Sequence[str] | str, overwrite: bool = False) -> DataFrame:
    """Remote files still to fetch; with ``overwrite`` all of them."""
    return remote if overwrite else absent(remote, held, on)


def distinct_names(listing: DataFrame, name: str = "name") -> DataFrame:
    return listing.select(name).distinct().orderBy(name)


def all_files(new: DataFrame, held: DataFrame) -> DataFrame:
    """New and already held files, for a catalogue sync."""
    return new.unionByName(held, allowMissingColumns=True)
