"""Every registered query against its SQL, on the smallest data set."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from tickbars.plans.oracles import ORACLES
from tickbars.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    run, sql = contract.queries()[name], contract.oracle_sql()[name]
    assert differences(spark, connection, SF_DIR, run, sql) == []
