"""Every query of the library against its SQL."""

import pytest

import __spark_entry__ as entry
from workload.compare import difference, duck
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert difference(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
