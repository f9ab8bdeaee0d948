"""Registered queries against their SQL, on the smallest tables."""

import pytest
from oracle_check import compare, connect

import corpus_pipeline
from shelfmark.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_one_query_for_each_operator():
    assert sorted(int(name.split("_")[0][2:]) for name in REGISTRY) == list(range(1, 14))
    assert set(ORACLE) <= set(REGISTRY)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_with_sql(spark, con, name):
    assert compare(REGISTRY[name](spark, SF), con, ORACLE[name]) is None
