"""Every registered query against its SQL twin, on whole tables."""

import os

import pytest
from parity import connect, differences

import __spark_entry__ as entry_module
from devicepulse.workload.catalog import QUERIES, SQL

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


def test_every_query_is_registered():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(SQL) <= set(entry_module.oracle_sql())


def test_entry(spark):
    first, second = entry_module.entry(spark), entry_module.entry(spark)
    assert first.count() > 0 and first.schema == second.schema
