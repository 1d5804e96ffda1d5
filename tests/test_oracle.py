"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_module
from lexiloom.plans import load
from tests.compare import difference, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


# Too slow or not to be said in SQL; compared with brute force in test_without_sql.py.
WITHOUT_SQL = {"nearest_in_cells", "segment_turns", "segment_turns_bigram"}


def test_every_other_query_of_the_plans_has_sql():
    registry = load()
    assert set(registry.QUERIES) == set(registry.SQL) | WITHOUT_SQL
    assert set(registry.QUERIES) <= set(entry_module.queries()) and set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", list(load().SQL))
def test_query_matches_sql(spark, con, name):
    got = entry_module.queries()[name](spark, SF_DIR).toPandas()
    sql = entry_module.oracle_sql()[name]
    assert difference(got, con.execute(sql).fetchdf()) is None


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
