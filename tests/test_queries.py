"""Every query against its SQL on the smallest data set."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from conformance.check import compare, connect
from conformance.queries import ORACLE, QUERIES

SF_DIR = "/root/testdata/sf0.001"

needs_data = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test data")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLE) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@needs_data
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    ok, note = compare(spark, db, name, SF_DIR)
    assert ok, note


@needs_data
def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
