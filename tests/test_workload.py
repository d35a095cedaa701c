"""Every registered query against its SQL, at the smallest scale."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import connect, difference
from workload.oracle import ORACLE
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_names():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, name):
    assert difference(spark, con, SF, queries()[name], oracle_sql()[name]) is None
