"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import differences, duck

# The queries of the training-data subpackage have tests of their own.
QUERIES = {name: q for name, q in contract.queries().items() if name not in contract.LLM_QUERIES}
ORACLES = {name: sql for name, sql in contract.oracle_sql().items() if name not in contract.LLM_QUERIES}


@pytest.fixture(scope="module")
def db(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    assert differences(spark, db, QUERIES[name], ORACLES[name], sf_dir) == ""


def test_entry(spark):
    assert contract.entry(spark).columns == ["month", "average"]
