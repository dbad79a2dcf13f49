"""Every query against its SQL on the smallest data set."""

import os

import pytest

from workload.check import difference, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 24
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
