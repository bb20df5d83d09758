import pytest
from pyspark.sql import functions as F

from curbside import functions as X
from curbside.functions.timeparse import check_clock, check_hour


def one_column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def results(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_parse_keeps_bad_text_as_null(spark):
    texts = {
        "01-JAN-24 08.30.00 AM": "2024-01-01 08:30:00",
        "01-Jan-24 08.30.00 pm": "2024-01-01 20:30:00",
        "10-MAR-24 12.05.00 AM": "2024-03-10 00:05:00",
        "10-MAR-24 12.00.00 PM": "2024-03-10 12:00:00",
        "31-DEC-99 11.59.59 PM": "2099-12-31 23:59:59",
        "1-JAN-24 08.30.00 AM": None,
        "30-FEB-24 08.30.00 AM": None,
        "not a time": None,
        "": None,
        None: None,
    }
    df = one_column(spark, list(texts))
    got = results(df, X.parse_session_ts("v").cast("string"))
    assert got == list(texts.values())


def test_calendar_texts(spark):
    df = spark.sql("SELECT timestamp'2024-01-07 09:05:07' AS t UNION ALL SELECT NULL")
    got = df.select(X.event_date("t"), X.clock("t"), X.weekday("t")).collect()
    assert [tuple(r) for r in got] == [("2024-01-07", "09:05:07", "Sun"), (None,) * 3]


def test_quarter_hours(spark):
    clocks = ["00:00:00", "08:14:59", "08:15:00", "08:44:10", "23:59:59", None]
    expected = ["00:00", "08:00", "08:15", "08:30", "23:45", ""]
    assert results(one_column(spark, clocks), X.window_15min(F.col("v"))) == expected


def test_hours(spark):
    df = one_column(spark, ["09:05:00", "17:59:59", None])
    assert results(df, X.window_hour(F.col("v"))) == ["09", "17", None]


def test_request_hours(spark):
    assert X.request_hour("9:00") == 9
    assert X.request_hour("11:00:00") == 11
    for bad in ("", "noon", "24:00", "-1:00"):
        with pytest.raises(ValueError):
            X.request_hour(bad)
    df = one_column(spark, ["9:00", " 11:30", "noon", "", None])
    assert results(df, X.request_hour_column("v")) == [9, 11, None, None, None]


def test_request_checks():
    assert check_clock("11:00:00") == "11:00:00"
    for bad in ("9:00:00", "11:00", "24:00:00", "11:60:00"):
        with pytest.raises(ValueError):
            check_clock(bad)
    assert check_hour(9) == 9 and check_hour(17) == 17
    for bad in (8, 18):
        with pytest.raises(ValueError):
            check_hour(bad)


def test_weekdays_in_any_case(spark):
    assert X.weekday_name("sUN ") == "Sun"
    with pytest.raises(ValueError):
        X.weekday_name("Someday")
    df = one_column(spark, ["mon", "SAT", " Sun", "x", None])
    assert results(df, X.weekday_name_column("v")) == ["Mon", "Sat", "Sun", None, None]


def test_possibility(spark):
    df = one_column(spark, [0.0, 1.0, 276.0, 552.0, 553.0, 600.0, float("nan"), None], "double")
    got = results(df, X.possibility(F.col("v"), 553))
    assert got == [0.0, 0.0, 0.5, 1.0, 1.0, 1.0, None, None]
    ties = one_column(spark, [1.0, 3.0], "double")
    assert results(ties, X.possibility(F.col("v"), 8)) == [0.12, 0.38]


def test_possibility_is_pythons_rounding_for_every_count(spark):
    df = spark.range(554).select(F.col("id").alias("x"))
    got = results(df.orderBy("x"), X.possibility(F.col("x"), 553))
    assert got == [1.0 if x >= 553 else round(float(x / 553), 2) for x in range(554)]


def test_half_even(spark):
    df = one_column(spark, [0.5, 1.5, 2.5, 2.51, None], "double")
    assert results(df, X.round_half_even(F.col("v"))) == [0, 2, 2, 3, None]


def test_labels(spark):
    df = spark.createDataFrame([(3, 57), (None, 0)], "a long, b long")
    got = df.select(
        X.occupancy_label(F.col("a"), F.col("b")), X.ratio_label(F.col("a"), F.col("b"))
    ).collect()
    assert [tuple(r) for r in got] == [
        ("Historical Occupancy = 3/57", "3/57"),
        ("Historical Occupancy = None/0", "None/0"),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
def test_times_do_not_depend_on_the_session_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    # The clocks of Los Angeles skip this hour.
    df = one_column(spark, ["10-MAR-19 02.30.00 AM", "03-NOV-19 01.30.00 AM"])
    ts = X.parse_session_ts("v")
    got = df.select(
        X.event_date(ts), X.clock(ts), X.weekday(ts), F.hour(ts)
    ).collect()
    assert [tuple(r) for r in got] == [
        ("2019-03-10", "02:30:00", "Sun", 2),
        ("2019-11-03", "01:30:00", "Sun", 1),
    ]
