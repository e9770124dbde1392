"""All registered queries against their SQL twins on the smallest tables."""

import pytest

import __spark_entry__ as entry
from listing_lake.plans import oracles
from listing_lake.plans import queries as registry
from tests import oracle_check

SF = "/root/testdata/sf0.001"
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(SF)


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, con, name):
    found = oracle_check.frame_of(registry.queries()[name](spark, SF))
    assert oracle_check.compare(found, oracle_check.frame_of_sql(con, SQL[name])) == "ok"


def test_every_query_here_has_sql():
    assert set(registry.queries()) == set(SQL) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
