import pytest

import __spark_entry__ as driver
from compare import connect, difference
from shelfmark.queries.registry import ALL

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(ALL))
def test_query_matches_its_sql(spark, duck, name):
    frame = driver.queries()[name](spark, SMALL)
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert frame.collect()
    else:
        assert difference(frame, sql, duck) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() > 0


def test_every_query_has_sql():
    assert [name for name, (_, sql) in ALL.items() if sql is None] == []
    assert set(ALL) <= set(driver.queries())
