"""Every registered query against its SQL. CHECK_SF_DIR picks the data (default the smallest)."""

from __future__ import annotations

import os

import pytest

from sunloom.queries import ORACLES, QUERIES
from tests.compare import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR).toPandas()
    assert differences(found, duck.execute(ORACLES[name]).df()) is None
