"""Every registered query runs; those with SQL give the same rows as an independent engine."""

import pytest

from gable.plans import QUERIES, SQL
from tests.compare import connect, difference, rows_of_spark, rows_of_sql


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, sf_dir, con, name):
    assert difference(rows_of_spark(QUERIES[name].run(spark, sf_dir)), rows_of_sql(con, SQL[name])) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name].run(spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
