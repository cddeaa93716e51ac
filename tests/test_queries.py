"""Every registered query against its SQL, in a session whose zone is not UTC."""

import pytest

import __spark_entry__ as entry_point
from oracle import connect, differences
from tallybrook import registry

QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    frame = entry_point.entry(spark)
    assert frame.count() == 116
    assert len(frame.columns) == 11


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, connection, name):
    assert differences(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) == []
