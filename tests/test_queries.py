"""Every registered query with SQL, on the smallest driver tables."""

import pytest

import __spark_entry__ as contract
from check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    outcome, n, _ = compare(spark, con, SF_DIR, contract.queries()[name], contract.oracle_sql().get(name))
    assert outcome in ("same", "no sql")
    assert n > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["customer_id", "total_spent"]
