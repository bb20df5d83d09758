from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

import curbside as cb
from conftest import SMALL
from curbside import fixtures
from curbside.plans import jobs
from curbside.schemas import SESSION_COLUMNS


@pytest.fixture
def files(spark, tmp_path):
    log = fixtures.raw_sessions(spark, SMALL).select(*SESSION_COLUMNS)
    cb.write_csv(log, f"{tmp_path}/log")
    cb.write_csv(log.select(F.lit("0").alias("NOT_IN_USE"), "*"), f"{tmp_path}/half", header=False)
    cb.write_csv(fixtures.raw_meters(spark, SMALL, as_text=True), f"{tmp_path}/meters")
    return str(tmp_path)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_load_and_query_end_to_end(spark, files):
    cb.load_sessions(spark, f"{files}/log", f"{files}/meters", f"{files}/sessions")
    log = fixtures.raw_sessions(spark, SMALL).select(*SESSION_COLUMNS)
    expected = cb.build_sessions(log, fixtures.raw_meters(spark, SMALL))
    assert same(expected, spark.read.parquet(f"{files}/sessions"))

    cb.load_half_file(spark, f"{files}/half", f"{files}/old")
    assert same(cb.clean_sessions(log), spark.read.parquet(f"{files}/old"))
    cb.load_half_file(spark, f"{files}/half", f"{files}/old")
    assert spark.read.parquet(f"{files}/old").count() == 2 * log.count()

    cb.load_meters(spark, f"{files}/meters", f"{files}/inventory")
    meters = spark.read.parquet(f"{files}/inventory")
    assert same(fixtures.meters(spark, SMALL), meters)

    cb.load_meter_weekday_counts(spark, f"{files}/log", f"{files}/counts")
    counts = spark.read.parquet(f"{files}/counts")
    assert same(cb.sessions_per_meter_weekday(cb.clean_sessions(log)), counts)

    cb.load_weekday_sessions(spark, f"{files}/log", f"{files}/meters", f"{files}/weekdays")
    table = spark.read.parquet(f"{files}/weekdays")
    assert table.count() == log.count()
    assert "start_time" not in table.columns and "CAP_COLOR" in table.columns

    cb.build_hour_pivot(spark, f"{files}/weekdays", f"{files}/pivot")
    pivot = spark.read.parquet(f"{files}/pivot")
    assert same(cb.hour_pivot(fixtures.typed_sessions(spark, SMALL)), pivot)

    place = (37.779, -122.41, 1500.0, "Mon")
    q1 = cb.avg_sessions_at(table, meters, *place, "11:00:00").first()
    q2 = cb.avg_meters_in_hour(table, meters, *place, 11).first()
    assert (q1.avg_sessions, q2.avg_meters, q1.n_meters) == (2.0, 1.75, 150)


def test_relational_target():
    df = MagicMock()
    jobs._save(df, ({"url": "jdbc:x:y"}, "t"), "append")
    df.write.mode.assert_called_once_with("append")
    df.write.mode.return_value.jdbc.assert_called_once_with("jdbc:x:y", "t", properties={})
