"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_its_sql(spark, con, name):
    assert compare(spark, con, name, FOLDER) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["records", "k_total", "error_k_total", "window_start", "window_end"]
    assert not df.isEmpty()


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
