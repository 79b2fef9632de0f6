"""Every registered query against its SQL twin."""

import os

import pytest

import __spark_entry__ as entry
from clickloom.plans.catalogue import all_queries
from clickloom.plans.oracle import all_oracles
from oracle_compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(all_queries()) == set(all_oracles())
    assert set(all_queries()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, con, name):
    assert compare(all_queries()[name](spark, SF_DIR), con, all_oracles()[name]) is None


def test_entry_runs(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 15
