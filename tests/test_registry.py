"""Every registered query against its SQL check on the smallest test folder."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry_points
from coursetrail.registry.oracle import all_sql
from coursetrail.registry.queries import all_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_every_query_has_a_check():
    assert set(all_queries()) == set(all_sql())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, connection, name):
    problem, _ = compare(spark, connection, FOLDER, all_queries()[name], all_sql()[name])
    assert not problem, problem


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
