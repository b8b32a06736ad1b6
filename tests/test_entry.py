"""The driver contract: entry, queries and oracles; every registered query runs on sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "status" in df.columns


def test_oracles_have_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF001)
    assert len(df.columns) == len(set(df.columns))
    df.write.format("noop").mode("overwrite").save()
