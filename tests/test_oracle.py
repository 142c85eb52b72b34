"""Every registered query against its oracle SQL on the smallest data."""

import pytest
from compare import compare, duck
from conftest import SMALL

from __spark_entry__ import entry
from opdiag.suite.oracle import SQL as ORACLE
from opdiag.suite.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    assert name in ORACLE
    _, problems = compare(spark, con, QUERIES[name], ORACLE[name], SMALL)
    assert not problems


def test_no_oracle_without_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
