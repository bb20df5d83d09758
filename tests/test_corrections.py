import os
import time

import pytest
from pyspark.sql import functions as F

import curbside as cb
from curbside.schemas import SESSION_COLUMNS
from curbside.streaming import corrections


def line(post, day, hour):
    return (post, "b", "p", f"{day:02d}-JAN-24 {hour:02d}.00.00 AM",
            f"{day:02d}-JAN-24 {hour:02d}.30.00 AM", "t", "1")


def write(path, rows, tick):
    os.makedirs(path.parent, exist_ok=True)
    text = ",".join(SESSION_COLUMNS) + "\n" + "".join(",".join(r) + "\n" for r in rows)
    path.write_text(text)
    at = time.time() - 1000 + tick
    os.utime(path, (at, at))


def current(spark, table):
    rows = cb.read_corrected(spark, table)
    return sorted(
        (os.path.basename(r.source_file), r.POST_ID, r.EventDate, r.StartTime, r.Day_Of_Week)
        for r in rows.collect()
    )


def rebuilt(spark, landing, folder):
    cb.refresh_corrected(spark, str(landing), str(folder))
    return current(spark, str(folder))


@pytest.fixture
def landed(tmp_path):
    landing = tmp_path / "landing"
    write(landing / "a.csv", [line("1", 1, 9), line("1", 2, 10), line("2", 3, 8)], 0)
    write(landing / "sub" / "b 1.csv", [line("3", 1, 9)], 0)
    return landing, str(tmp_path / "table"), tmp_path


def test_a_file_that_comes_again_replaces_its_rows(spark, landed):
    landing, table, base = landed
    assert cb.refresh_corrected(spark, str(landing), table) == 4
    assert cb.refresh_corrected(spark, str(landing), table) == 0
    # Fewer rows, another weekday, the same number of bytes as nothing else.
    write(landing / "a.csv", [line("9", 4, 9)], 5)
    write(landing / "c.csv", [line("4", 1, 7)], 5)
    assert cb.refresh_corrected(spark, str(landing), table) == 2
    assert current(spark, table) == rebuilt(spark, landing, base / "again")
    assert [r[:2] for r in current(spark, table)] == [
        ("a.csv", "9"), ("b%201.csv", "3"), ("c.csv", "4"),
    ]
    # Equal size, later time.
    write(landing / "a.csv", [line("8", 4, 9)], 9)
    assert cb.refresh_corrected(spark, str(landing), table) == 1
    assert current(spark, table) == rebuilt(spark, landing, base / "third")


@pytest.mark.parametrize("at", ["rows", "ledger"])
def test_a_run_that_dies_counts_nothing_twice(spark, landed, monkeypatch, at):
    landing, table, base = landed
    cb.refresh_corrected(spark, str(landing), table)
    before = current(spark, table)
    write(landing / "a.csv", [line("7", 5, 9), line("7", 6, 9)], 5)

    def die(*args):
        raise RuntimeError("lost")

    if at == "ledger":
        monkeypatch.setattr(corrections, "_commit", die)
    else:
        broken = F.raise_error(F.lit("lost"))
        real = corrections.clean_sessions
        monkeypatch.setattr(
            corrections, "clean_sessions",
            lambda raw, window: real(raw, window).where(F.when(F.col("POST_ID") == "7", broken).isNull()),
        )
    with pytest.raises(Exception):
        cb.refresh_corrected(spark, str(landing), table)
    # Readers still see the old rows.
    assert current(spark, table) == before
    monkeypatch.undo()
    assert cb.refresh_corrected(spark, str(landing), table) == 2
    assert current(spark, table) == rebuilt(spark, landing, base / "again")


def test_batches_meters_and_compaction(spark, landed):
    landing, table, base = landed
    meters = spark.createDataFrame(
        [("1", "Grey", "-122.4", "37.7"), ("3", "Red", "-122.5", "37.8")],
        "POST_ID string, CAP_COLOR string, LONGITUDE string, LATITUDE string",
    )
    assert cb.refresh_corrected(spark, str(landing), table, meters, files_per_batch=1) == 4
    assert {(r.POST_ID, r.CAP_COLOR) for r in cb.read_corrected(spark, table).collect()} == {
        ("1", "Grey"), ("3", "Red"),
    }
    write(landing / "a.csv", [line("1", 4, 9)], 5)
    cb.refresh_corrected(spark, str(landing), table, meters)
    small = str(base / "small")
    cb.drop_replaced(spark, table, small)
    assert current(spark, small) == current(spark, table)
    assert spark.read.parquet(f"{small}/rows").count() == 2
    assert cb.refresh_corrected(spark, str(landing), small, meters) == 0
