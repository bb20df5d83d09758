import os
import time

import pytest
from pyspark.sql import functions as F

import curbside as cb
from conftest import SMALL
from curbside import fixtures
from curbside.schemas import HALF_FILE_SCHEMA, SESSION_COLUMNS


@pytest.fixture
def log(spark):
    return fixtures.raw_sessions(spark, SMALL).select(*SESSION_COLUMNS)


def part(log, k):
    return log.where(F.pmod(F.xxhash64("SESSION_START_DT", "POST_ID"), F.lit(3)) == k)


def folders(tmp_path):
    return [f"{tmp_path}/{name}" for name in ("landing", "table", "checkpoint")]


def test_each_file_is_loaded_once(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    loaded = 0
    for k in range(3):
        cb.write_csv(part(log, k), landing, mode="append")
        new = part(log, k).count()
        assert cb.refresh_sessions(spark, landing, table, checkpoint) == new
        assert cb.refresh_sessions(spark, landing, table, checkpoint) == 0
        loaded += new
        assert spark.read.parquet(table).count() == loaded
    expected = cb.clean_sessions(log)
    got = spark.read.parquet(table).select(*expected.columns)
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0


def test_file_with_an_old_date_is_loaded(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    cb.write_csv(part(log, 0), landing, mode="append")
    cb.refresh_sessions(spark, landing, table, checkpoint)
    before = set(os.listdir(landing))
    cb.write_csv(part(log, 1), landing, mode="append")
    old = time.time() - 90 * 24 * 3600
    for name in set(os.listdir(landing)) - before:
        os.utime(f"{landing}/{name}", (old, old))
    assert cb.refresh_sessions(spark, landing, table, checkpoint) == part(log, 1).count()


def test_with_meters(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    cb.write_csv(log, landing)
    meters = fixtures.raw_meters(spark, SMALL)
    cb.refresh_sessions(spark, landing, table, checkpoint, meters=meters, window="15min")
    expected = cb.build_sessions(log, meters)
    got = spark.read.parquet(table).select(*expected.columns)
    assert got.exceptAll(expected).count() == expected.exceptAll(got).count() == 0


def test_headerless_half_file(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    half = log.select(F.lit("0").alias("NOT_IN_USE"), "*")
    cb.write_csv(half, landing, header=False)
    cb.refresh_sessions(
        spark, landing, table, checkpoint, header=False, schema=HALF_FILE_SCHEMA
    )
    assert spark.read.parquet(table).count() == log.count()


def test_wrong_header_fails_and_loads_nothing(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    cb.write_csv(log.select(*reversed(SESSION_COLUMNS)), landing)
    with pytest.raises(Exception, match="(?i)header"):
        cb.refresh_sessions(spark, landing, table, checkpoint)


def test_rows_without_a_weekday_are_kept(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    cb.write_csv(log.withColumn("SESSION_START_DT", F.lit("bad")), landing)
    cb.refresh_sessions(spark, landing, table, checkpoint)
    kept = spark.read.parquet(table)
    assert kept.count() == kept.where("Day_Of_Week IS NULL").count() == log.count()


def test_nothing_has_arrived_yet(spark, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    os.mkdir(landing)
    assert cb.refresh_sessions(spark, landing, table, checkpoint) == 0


def test_with_meters_too_many_to_broadcast(spark, log, tmp_path, never_broadcast):
    landing, table, checkpoint = folders(tmp_path)
    cb.write_csv(log, landing)
    meters = fixtures.raw_meters(spark, SMALL)
    cb.refresh_sessions(spark, landing, table, checkpoint, meters=meters)
    assert spark.read.parquet(table).count() == log.count()


def test_small_batches_are_all_counted_and_one_weekday_is_read(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    for _ in range(3):
        cb.write_csv(log.repartition(2), landing, mode="append")
    rows = cb.refresh_sessions(spark, landing, table, checkpoint, files_per_batch=1)
    assert rows == 3 * log.count() == spark.read.parquet(table).count()
    monday = cb.read_weekday(spark, table, "Mon")
    assert monday.count() == 3 * cb.on_weekday(cb.clean_sessions(log), "Mon").count()


def test_files_per_weekday_and_batch_are_bounded(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    cb.write_csv(log.repartition(8), landing)
    cb.refresh_sessions(spark, landing, table, checkpoint, files_per_weekday=2)
    for day in os.listdir(table):
        if day.startswith("Day_Of_Week="):
            files = [f for f in os.listdir(f"{table}/{day}") if f.endswith(".parquet")]
            assert len(files) <= 2


def test_loaded_files_are_archived(spark, log, tmp_path):
    landing, table, checkpoint = folders(tmp_path)
    for k in range(3):
        cb.write_csv(part(log, k), landing, mode="append")
        rows = cb.refresh_sessions(
            spark, landing, table, checkpoint, archive=f"{tmp_path}/archive"
        )
        assert rows == part(log, k).count()
    assert spark.read.parquet(table).count() == log.count()
