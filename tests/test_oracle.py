import sys, os
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
"""Every registered query against its DuckDB twin on the smallest folder."""

import pytest
from check import compare, connect

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_twin(spark, con, name):
    out = compare(spark, con, FOLDER, name)
    assert not out.startswith("FAIL"), out


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
