"""Every registered query equals its SQL answer on the whole tables."""

import importlib

import pytest

import parity

entry = importlib.import_module("__spark_entry__")
#: The corpus operators have tests of their own and can be taken out.
CORPUS = set(entry.corpus.queries()) if entry.corpus else set()
QUERIES = {name: query for name, query in entry.queries().items() if name not in CORPUS}
ANSWERS = {name: answer for name, answer in entry.oracle_sql().items() if name not in CORPUS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return parity.connect(sf_dir)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ANSWERS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert parity.differences(spark, con, sf_dir, QUERIES[name], ANSWERS[name]) == ([], [])


def test_entry(spark):
    rows = entry.entry(spark)
    assert len(rows.columns) == 23
    assert rows.count() == 150
