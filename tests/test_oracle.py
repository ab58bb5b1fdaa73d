"""Registered queries against their SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert compare(entry.queries()[name](spark, SF), duck, ORACLE[name]) is None
