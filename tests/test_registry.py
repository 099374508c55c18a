"""Every registered query against its SQL, on the smallest tables."""

import os
import subprocess
import sys
from pathlib import Path

import pytest
from oracle import connect, differences

import __spark_entry__ as contract
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= contract.queries().keys() and ORACLES.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, name):
    assert differences(contract.queries()[name](spark, SF_DIR), duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_a_module_that_is_not_there_costs_the_optional_queries_alone():
    code = (
        "import sys; sys.modules['public_tokenizers'] = None\n"
        "import __spark_entry__ as e; from registry.queries import QUERIES\n"
        "assert list(e.queries()) == list(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)"
    )
    root = Path(__file__).parents[1]
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
