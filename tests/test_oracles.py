"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import database, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    assert difference(df, con, entry_points.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["skill", "category", "total_postings", "latest_month", "latest_count",
                          "prev_count", "mom_pct"]
    assert df.count() == 13
