import pytest
from pyspark.sql import functions as F

import curbside as cb
from conftest import SMALL
from curbside import fixtures
from curbside.schemas import SESSION_SCHEMA

HEADER = [f.name for f in SESSION_SCHEMA.fields]


def log(spark, *rows):
    """Rows of meter, start and end as a payment log."""
    full = [(m, "b", "p", s, e, "t", "1.0") for m, s, e in rows]
    return spark.createDataFrame(full, SESSION_SCHEMA)


@pytest.fixture
def raw(spark):
    return log(
        spark,
        ("1", "01-JAN-24 09.00.00 AM", "01-JAN-24 11.00.00 AM"),
        ("1", "01-JAN-24 11.50.00 PM", "02-JAN-24 12.20.00 AM"),
        ("2", "bad", "01-JAN-24 05.30.00 PM"),
        ("2", None, None),
        (None, "06-JAN-24 08.00.00 AM", "06-JAN-24 09.00.00 AM"),
        ("9", "07-JAN-24 08.00.00 AM", "07-JAN-24 09.14.00 AM"),
    )


def inventory(spark):
    rows = [
        ("1", "Grey", "-122.41", "37.78"),
        ("2", "Green", "-122.42", "n/a"),
        ("2", "Green", None, ""),
        ("3", "Red", "-122.40", "37.79"),
        (None, "Red", "-122.40", "37.79"),
    ]
    return spark.createDataFrame(
        rows, "POST_ID string, CAP_COLOR string, LONGITUDE string, LATITUDE string"
    )


def test_clean_sessions(raw):
    clean = cb.clean_sessions(raw, "15min")
    assert clean.columns == [
        "POST_ID", "start_time", "end_time", "EventDate", "StartTime", "EndTime",
        "Day_Of_Week", "start_hour", "end_hour", "StartWindow", "EndWindow",
    ]
    got = {
        tuple(r)
        for r in clean.select(
            "POST_ID", "EventDate", "StartTime", "EndTime", "Day_Of_Week",
            "StartWindow", "EndWindow", "start_hour", "end_hour",
        ).collect()
    }
    assert got == {
        ("1", "2024-01-01", "09:00:00", "11:00:00", "Mon", "09:00", "11:00", 9, 11),
        ("1", "2024-01-01", "23:50:00", "00:20:00", "Mon", "23:45", "00:15", 23, 0),
        ("2", None, None, "17:30:00", None, "", "17:30", None, 17),
        ("2", None, None, None, None, "", "", None, None),
        (None, "2024-01-06", "08:00:00", "09:00:00", "Sat", "08:00", "09:00", 8, 9),
        ("9", "2024-01-07", "08:00:00", "09:14:00", "Sun", "08:00", "09:00", 8, 9),
    }


def test_hour_windows_keep_null(raw):
    rows = cb.clean_sessions(raw, "hour").select("StartWindow", "EndWindow").collect()
    assert {tuple(r) for r in rows} == {
        ("09", "11"), ("23", "00"), (None, "17"), (None, None), ("08", "09"),
    }


def test_window_name_is_checked(raw):
    with pytest.raises(ValueError):
        cb.clean_sessions(raw, "day")


def test_publishable_and_half_file(raw):
    clean = cb.publishable(cb.clean_sessions(raw.withColumn("NOT_IN_USE", F.lit("0"))))
    assert "NOT_IN_USE" not in clean.columns
    assert not {"start_time", "end_time"} & set(clean.columns)


def test_meter_base(spark):
    base = cb.meter_base(inventory(spark))
    assert base.columns == ["POST_ID", "CAP_COLOR", "longitude", "latitude"]
    assert [f.dataType.typeName() for f in base.schema.fields[2:]] == ["double"] * 2
    got = {(r.POST_ID, r.longitude, r.latitude) for r in base.collect()}
    assert got == {
        ("1", -122.41, 37.78), ("2", -122.42, None), ("2", None, None),
        ("3", -122.40, 37.79), (None, -122.40, 37.79),
    }
    coarse = cb.meter_base(inventory(spark), parity=True)
    assert coarse.schema["latitude"].dataType.typeName() == "float"


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_attach_meter_is_inner_and_multiplies_copies(spark, conf, raw, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    joined = cb.build_sessions(raw, inventory(spark))
    counts = {r.POST_ID: r["count"] for r in joined.groupBy("POST_ID").count().collect()}
    assert counts == {"1": 2, "2": 4}
    assert joined.columns.count("POST_ID") == 1
    copies = cb.duplicate_meters(cb.meter_base(inventory(spark))).collect()
    assert [tuple(r) for r in copies] == [("2", 2)]


def test_typed_sessions_equal_the_parsed_log(spark):
    parsed = cb.clean_sessions(fixtures.raw_sessions(spark, SMALL), "15min")
    typed = fixtures.typed_sessions(spark, SMALL, "15min")
    assert parsed.columns == typed.columns
    assert parsed.exceptAll(typed).count() == 0
    assert typed.exceptAll(parsed).count() == 0


def test_aggregates_keep_null_keys(raw):
    clean = cb.clean_sessions(raw)
    counts = {tuple(r) for r in cb.sessions_per_meter_weekday(clean).collect()}
    assert counts == {
        ("1", "Mon", 2), ("2", None, 2), (None, "Sat", 1), ("9", "Sun", 1),
    }
    days = {tuple(r) for r in cb.active_days_per_meter_weekday(clean).collect()}
    assert days == {
        ("1", "Mon", 1), ("2", None, 0), (None, "Sat", 1), ("9", "Sun", 1),
    }
    observed = {tuple(r) for r in cb.observed_days(clean).collect()}
    assert observed == {("Mon", 1), ("Sat", 1), ("Sun", 1)}
    assert cb.observed_days(clean, by_weekday=False).first()[0] == 3


def test_filters_at_the_edges(spark):
    rows = [
        ("strict start", "11:00:00", "12:00:00"),
        ("strict end", "10:00:00", "11:00:00"),
        ("inside", "10:59:59", "11:00:01"),
        ("midnight", "23:50:00", "11:30:00"),
    ]
    df = spark.createDataFrame(rows, "name string, StartTime string, EndTime string")
    assert [r.name for r in cb.in_progress_at(df, "11:00:00").collect()] == ["inside"]

    hours = [(8, 12), (9, 9), (9, 17), (9, 18), (10, 11), (11, 11), (12, 17), (11, 10)]
    df = spark.createDataFrame(hours, "start_hour int, end_hour int")
    got = [tuple(r) for r in cb.occupied_in_hour(df, 11).collect()]
    assert got == [(9, 17), (10, 11), (11, 11)]
    assert [tuple(r) for r in cb.occupied_in_hour(df, 9).collect()] == [(9, 9), (9, 17)]
    with pytest.raises(ValueError):
        cb.occupied_in_hour(df, 18)


def test_pivot_counts_days_per_hour(spark):
    rows = [
        ("a", "d1", 9, 11), ("a", "d1", 10, 12), ("a", "d2", 11, 17),
        ("b", "d1", 8, 12), ("b", "d1", 10, 18), ("b", "d1", 17, 17),
        ("c", "d1", 16, 17), ("c", "d2", 23, 1), ("c", "d3", 12, 10),
        (None, "d1", 10, 10),
    ]
    df = spark.createDataFrame(
        rows, "POST_ID string, EventDate string, start_hour int, end_hour int"
    ).withColumn("Day_Of_Week", F.lit("Mon"))
    pivot = cb.hour_pivot(df)
    got = {r[0]: tuple(r)[1:] for r in pivot.collect()}
    assert got == {"a": (1, 1, 2, 2, 1, 1, 1, 1), "c": (0, 0, 0, 0, 0, 0, 0, 1)}
    for hour in range(9, 17):
        days = cb.occupied_days(cb.occupied_in_hour(df, hour)).collect()
        positive = cb.hour_column(pivot, hour).where("n_days > 0").collect()
        assert {tuple(r) for r in days} == {tuple(r) for r in positive}
    with pytest.raises(ValueError):
        cb.hour_column(pivot, 17)
