"""Queries that SQL can express equal their SQL answers on the whole tables."""

import parity
import pytest

from carelens.llm.queries import oracle_sql, queries

ANSWERS = oracle_sql()


@pytest.mark.parametrize("name", sorted(ANSWERS))
def test_answer(spark, sf_dir, name):
    assert parity.differences(spark, parity.connect(sf_dir), sf_dir, queries()[name], ANSWERS[name]) == ([], [])
