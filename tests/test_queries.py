import __spark_entry__ as entry
import oracle
import pytest


@pytest.fixture(scope="module")
def con():
    return oracle.connect("/root/testdata/sf0.01")


def test_every_query_has_its_sql():
    assert set(entry.climate_queries()) == set(entry.climate_sql())
    assert set(entry.climate_queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", entry.climate_queries())
def test_query_equals_sql(spark, con, name):
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    assert oracle.differences(spark, "/root/testdata/sf0.01", con, query, sql) == {}


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.columns == [
        "key", "latitude", "longitude", "year", "season", "avg_temp", "data_points", "stations",
    ]
    assert rows.count() > 0
