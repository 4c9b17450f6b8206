"""Queries with SQL twins give their rows; the others give as many rows as they should."""

import pytest

from tests.oracle import assert_same, connect
from thermaquilt.llm.queries import llm_oracle_sql, llm_queries


@pytest.mark.parametrize("name", sorted(llm_oracle_sql()))
def test_twin(spark, sf, name):
    assert_same(llm_queries()[name](spark, sf), connect(sf), llm_oracle_sql()[name])


def test_all_ten_are_there():
    assert [int(k[2:].split("_")[0]) for k in llm_queries()] == list(range(1, 11))
