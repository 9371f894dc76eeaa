"""The registered queries against their comparison SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from staylens import catalogue
from tools.compare import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_comparison_sql():
    assert set(catalogue.entries()) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).limit(5).count() == 5


@pytest.mark.parametrize("name", list(catalogue.entries()))
def test_query_matches_sql(spark, con, name):
    matches, note = compare(spark, con, name, SF)
    assert matches, note
