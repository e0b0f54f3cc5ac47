"""Every query against its SQL, on the smallest sample tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect
from wardloom.plans.oracle import ORACLE
from wardloom.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_same_names():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query(spark, db, name):
    assert compare(spark, db, queries()[name], oracle_sql()[name], SF_DIR) is None


def test_entry(spark):
    assert entry(spark).columns == ["user_id", "notes", "provider_id", "notes_pos_sentiment", "id", "notes_type"]
