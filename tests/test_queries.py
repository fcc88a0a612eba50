"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from checks.compare import database, difference

QUERIES = entry_points.queries()
TWINS = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return database(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small, db, name):
    found = QUERIES[name](spark, small)
    if name in TWINS:
        assert difference(found, db, TWINS[name]) is None
    else:
        assert found.count() > 0


def test_twins_belong_to_queries():
    assert set(TWINS) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() == 6
