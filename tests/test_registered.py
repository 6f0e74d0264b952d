"""Every registered query against its SQL, whole results, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF) == []


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).limit(1).count() == 1


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
