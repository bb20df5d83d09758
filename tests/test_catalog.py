import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry_point
import oracle
from conftest import SMALL
from curbside import catalog

QUERIES = catalog.QUERIES
SQL = oracle.oracle_sql()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.fixture(scope="module", params=["sf0.001", "sf0.01"])
def data(request):
    sf_dir = f"/root/testdata/{request.param}"
    return sf_dir, connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, data, name):
    sf_dir, con = data
    got = spark_rows(QUERIES[name](spark, sf_dir))
    expected = sql_rows(con, SQL[name])
    assert got[0] == expected[0]
    assert len(got[1]) == len(expected[1]) > 0
    assert got[1] == expected[1]


SHUFFLED = [
    "enriched_sessions",
    "avg_sessions_at",
    "meters_per_date",
    "avg_meters_in_hour",
    "occupied_days_by_meter",
    "meter_possibility",
    "area_possibility",
    "locate_requests",
    "distance_join",
    "score_requests",
    "score_possibility",
    "score_in_progress",
]


@pytest.mark.parametrize("name", SHUFFLED)
def test_matches_sql_without_broadcasts(spark, never_broadcast, name):
    got = spark_rows(QUERIES[name](spark, SMALL))
    assert got == sql_rows(connect(SMALL), SQL[name])


def test_entry(spark):
    row = entry_point.entry(spark).first()
    assert row["n_meters"] == 57
    assert row["label"].endswith("/57")
