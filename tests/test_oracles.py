"""Every query with SQL gives the rows of its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as contract
from check_oracles import compare, connect

SF = "/root/testdata/sf0.001"
SLOW = {"cross_validation", "forest_confusion", "top_features", "refit_and_score", "stream_scored_windows", "image_features"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - SLOW))
def test_query_matches_sql(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
