"""Every query of the subpackage that SQL can express, against its SQL."""

import pytest
from oracle import connect, differences

import __spark_entry__ as contract
from chuvisco.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) == []


def test_all_are_registered():
    names = contract.queries().keys()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)} and QUERIES.keys() | {"pipeline"} <= names
    assert ORACLES.keys() <= contract.oracle_sql().keys()
