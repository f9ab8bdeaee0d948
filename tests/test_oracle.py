"""Every registered catalog query against its SQL on the smallest tables."""

import pytest
from oracle_check import compare, connect

import __spark_entry__ as driver
from shelfmark.workload.oracle import ORACLE
from shelfmark.workload.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)
    assert set(REGISTRY) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, name):
    assert compare(REGISTRY[name](spark, SF), con, ORACLE[name]) is None
