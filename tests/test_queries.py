"""Every registered query against its SQL twin."""

import compare
import pytest

import __spark_entry__ as entry
from tallyline.plans import catalog


@pytest.fixture(scope="module")
def duck(small):
    with compare.connect(small) as con:
        yield con


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_matches_sql(spark, duck, small, name):
    rows = catalog.QUERIES[name](spark, small)
    assert compare.differences(rows, duck, catalog.SQL[name]) is None


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["user_id", "tokens", "cost_usd", "requests"]
