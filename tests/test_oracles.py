"""Every named query runs, and those with SQL return the rows DuckDB returns."""

import os

import pytest

from tests.oracle import compare, connect
from trellis.plans.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_FOLDER", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    ok, note, _ = compare(spark, duck, FOLDER, name, QUERIES[name], ORACLES.get(name))
    assert ok, note
