"""The driver's contract."""

import __spark_entry__ as e

from tablewright.queries import QUERIES


def test_entry_runs(spark):
    assert e.entry(spark).count() > 0


def test_every_own_query_has_sql():
    assert set(QUERIES) <= set(e.oracle_sql()) and set(e.oracle_sql()) <= set(e.queries())
