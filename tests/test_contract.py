import os

import pytest

import __spark_entry__ as contract
from check import connect, same

SMALL = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_statement_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_statement(spark, con, name):
    df = contract.queries()[name](spark, SMALL)
    assert same(df.collect(), df.columns, con, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
