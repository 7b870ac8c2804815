"""Every registered query against its SQL in DuckDB at the smallest scale."""

import pytest

import __spark_entry__ as entry
import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.database(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query_matches_sql(spark, con, name):
    ok, note = check.compare(spark, con, SF_DIR, name)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
