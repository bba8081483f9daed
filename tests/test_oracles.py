"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_queries import compare, connect  # noqa: E402

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")


@pytest.fixture(scope="module")
def oracle():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_oracle(spark, oracle, name):
    verdict = compare(spark, oracle, SMALL, name)
    assert verdict.startswith(("ok", "rows only")), verdict


def test_contract():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
