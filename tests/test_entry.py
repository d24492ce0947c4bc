"""Driver contract: entry runs, every query builds and runs at sf0.001."""
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "text" in df.columns


def test_every_query_has_callable_and_oracle_names():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_runs(spark, name):
    df = E.queries()[name](spark, SF)
    df.limit(5).collect()
