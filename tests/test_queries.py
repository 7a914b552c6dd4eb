"""Every registered query with a SQL twin, side by side on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, duck

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_flagship(spark):
    assert entry.entry(spark).count() == 10


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    status, _, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], FOLDER)
    assert status in ("ok", "close"), note
