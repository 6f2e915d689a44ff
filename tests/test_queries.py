"""Every query with SQL against DuckDB on the smallest tables; the others give rows."""

import pytest

import __spark_entry__ as entry
from dayledger.workload import load
from tests.compare import difference


@pytest.mark.parametrize("name", sorted(load.ORACLES))
def test_equals_sql(spark, name):
    assert difference(spark, name, "0.001") is None


@pytest.mark.parametrize("name", sorted(set(load.QUERIES) - set(load.ORACLES)))
def test_gives_rows(spark, sf, name):
    assert not entry.queries()[name](spark, sf).isEmpty()


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() == 343


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
