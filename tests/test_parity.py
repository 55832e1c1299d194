"""Every registered query against its SQL twin on the smallest tables."""

import pytest
from parity import SMALLEST, database, difference

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def base():
    return database(SMALLEST)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, base, name):
    assert difference(spark, base, name, SMALLEST) is None


def test_twins_name_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 150
