"""Every named query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
from tools.compare import compare, connect

NAMES = list(entry.queries())


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", NAMES)
def test_query_gives_the_rows_of_its_sql(spark, con, sf, name):
    verdict, _, _ = compare(spark, con, name, sf)
    assert verdict in ("same", "rows only"), verdict


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
