"""Every registered query with a SQL counterpart gives the same rows."""

import pytest

import __spark_entry__ as contract
import oracle
from tablemargin.plans import registry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(registry.ORACLES) == set(registry.QUERIES)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, con, name):
    difference = oracle.compare(contract.queries()[name](spark, SF_DIR), con, contract.oracle_sql()[name])
    assert difference is None, difference


def test_entry(spark):
    assert contract.entry(spark).count() == 3
