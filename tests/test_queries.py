"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

SLOW = {"cv_grid_tree", "cv_random_boost"}
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, folder, con, name):
    df = entry.queries()[name](spark, folder)
    assert compare(df, con, ORACLES[name]) is None


@pytest.mark.parametrize(
    "name",
    [
        pytest.param(name, marks=pytest.mark.slow if name in SLOW else ())
        for name in sorted(set(entry.queries()) - set(ORACLES))
    ],
)
def test_query_without_sql_has_rows(spark, folder, name):
    assert entry.queries()[name](spark, folder).count() > 0


def test_oracles_name_known_queries():
    assert set(ORACLES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 1
