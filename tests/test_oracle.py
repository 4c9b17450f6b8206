"""Every query with a SQL twin gives its rows; the others give rows."""

import pytest

from tests.oracle import assert_same, connect
from thermaquilt.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    if name in ORACLE:
        assert_same(df, con, ORACLE[name])
    else:
        assert df.count() > 0


def test_entry_imports_without_llm(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 350
