import random
from fractions import Fraction

import pytest
from brute import days_per_meter, mean, meters_per_date, near, sessions_per_date
from pyspark.sql import functions as F

import curbside as cb
from conftest import SMALL
from curbside import fixtures

PLACE = (37.779, -122.41, 400.0)
SESSIONS = (
    "POST_ID string, EventDate string, Day_Of_Week string, StartTime string, "
    "EndTime string, start_hour int, end_hour int"
)
METERS = "POST_ID string, latitude double, longitude double"


def make_meters(rng, copies):
    spots = [(37.776 + rng.randrange(9) * 0.001, -122.414 + rng.randrange(9) * 0.001) for _ in range(12)]
    meters = [(f"m{i}", *rng.choice(spots)) for i in range(60)]
    meters += [("no place", None, None), ("far", 38.5, -122.41)]
    if copies:
        meters += [("m1", *meters[1][1:])] * 2
        meters += [("m2", *spots[0]), ("m2", *spots[5]), ("hot", *spots[3]), ("hot", *spots[7])]
    return meters + [("hot", *spots[2])]


def make_sessions(rng, n=900):
    rows = []
    for i in range(n):
        # A third of all sessions belong to one meter.
        meter = "hot" if i % 3 == 0 else rng.choice([f"m{rng.randrange(70)}", None, "far"])
        day = rng.randrange(14)
        start, end = sorted(rng.randrange(7 * 3600, 19 * 3600) for _ in range(2))
        if rng.random() < 0.1:
            start, end = end, start
        clock = [f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}" for s in (start, end)]
        weekday = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")[day % 7]
        rows.append((meter, f"2024-01-{day + 1:02d}", weekday, *clock, start // 3600, end // 3600))
    return rows


@pytest.fixture(
    params=[("10MB", False), ("10MB", True), ("-1", True)],
    ids=["broadcast", "broadcast-copies", "shuffled-copies"],
)
def data(spark, conf, request):
    limit, copies = request.param
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    rng = random.Random(7)
    meters, rows = make_meters(rng, copies), make_sessions(rng)
    sessions = spark.createDataFrame(rows, SESSIONS)
    names = sessions.columns
    plain = [dict(zip(names, r)) for r in rows]
    return sessions, spark.createDataFrame(meters, METERS), plain, meters


def label(value, total):
    return f"Historical Occupancy = {value if value is None else round(value)}/{total}"


def test_average_sessions(data):
    sessions, meters, plain, inventory = data
    for day, time in [("Mon", "11:00:00"), ("sun", "09:30:00")]:
        expected = sessions_per_date(plain, inventory, *PLACE, day.capitalize(), time)
        average = mean(expected.values())
        row = cb.avg_sessions_at(sessions, meters, *PLACE, day, time).first()
        in_range = len(near(inventory, *PLACE))
        assert row.avg_sessions == pytest.approx(average)
        assert (row.occupied, row.n_meters) == (round(average), in_range)
        assert row.label == label(average, in_range)


def test_average_meters(data):
    sessions, meters, plain, inventory = data
    for day, hour in [("Mon", 9), ("Tue", 11), ("Sat", 17)]:
        expected = meters_per_date(plain, inventory, *PLACE, day, hour)
        per_date = cb.meters_per_date(sessions, meters, *PLACE, day, hour)
        assert {r.EventDate: r.n_meters for r in per_date.collect()} == expected
        assert all(n <= len(near(inventory, *PLACE)) for n in expected.values())
        row = cb.avg_meters_in_hour(sessions, meters, *PLACE, day, hour).first()
        assert row.avg_meters == pytest.approx(mean(expected.values()))
        assert row.label == label(mean(expected.values()), len(near(inventory, *PLACE)))


def test_empty_area(data):
    sessions, meters, *_ = data
    nowhere = (10.0, 10.0, 100.0)
    for row in (
        cb.avg_sessions_at(sessions, meters, *nowhere, "Mon", "11:00:00").first(),
        cb.avg_meters_in_hour(sessions, meters, *nowhere, "Mon", 11).first(),
    ):
        assert tuple(row) == (None, None, 0, "Historical Occupancy = None/0")
    assert cb.occupied_days_by_meter(sessions, meters, *nowhere, "Mon", 11).count() == 0
    area = cb.area_possibility(cb.hour_pivot(sessions), meters, *nowhere, 11, 14).first()
    assert tuple(area) == (None, 0, 0, "None")


def test_days_by_meter(data):
    sessions, meters, plain, inventory = data
    days = days_per_meter(plain, "Mon", 11)
    for override, total in [(None, 2), (19, 19)]:
        got = cb.occupied_days_by_meter(sessions, meters, *PLACE, "Mon", 11, override)
        assert got.columns == ["POST_ID", "latitude", "longitude", "n_days", "total_days", "label"]
        expected = sorted(
            (m, lat, lon, days.get(m), total, f"{days[m]}/{total}" if m in days else "None")
            for m, lat, lon in near(inventory, *PLACE)
        )
        assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(expected, key=str)


def test_attach_days(data):
    _, meters, plain, inventory = data
    days = days_per_meter(plain, "Mon", 11)
    table = meters.sparkSession.createDataFrame(
        [(m, n) for m, n in days.items() if m], "POST_ID string, n_days long"
    )
    got = cb.attach_days(meters.select("POST_ID"), table, 19).collect()
    assert sorted((r.POST_ID, r.label) for r in got) == sorted(
        (m[0], f"{days[m[0]]}/19" if m[0] in days else "None") for m in inventory
    )


def test_possibilities(data):
    sessions, meters, plain, inventory = data
    pivot = cb.hour_pivot(sessions)
    for hour, total in [(9, 14), (11, 14), (16, 3)]:
        days = days_per_meter(plain, None, hour)
        expected = []
        for m, lat, lon in near(inventory, *PLACE):
            x = days.get(m, 0)
            chance = 1.0 if x >= total else round(x / total, 2)
            if chance > 0:
                expected.append((m, lat, lon, chance))
        got = cb.meter_possibility(pivot, meters, *PLACE, hour, total)
        assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
        area = cb.area_possibility(pivot, meters, *PLACE, hour, total).first()
        # The exact mean: a sum of doubles may fall on either side of a tie.
        cents = Fraction(sum(round(e[3] * 100) for e in expected), len(expected))
        assert area.possibility == round(cents) / 100
        assert area.n_meters_in_range == len(near(inventory, *PLACE))
        assert area.n_meters_used == len(expected)
        assert area.label == str(area.possibility)


def test_days_from_the_data(data):
    sessions, meters, *_ = data
    pivot = cb.hour_pivot(sessions)
    n_days = cb.observed_days(sessions, by_weekday=False).scalar()
    fixed = cb.meter_possibility(pivot, meters, *PLACE, 11, 14)
    derived = cb.meter_possibility(pivot, meters, *PLACE, 11, n_days)
    assert fixed.exceptAll(derived).count() == derived.exceptAll(fixed).count() == 0


def requests_table(spark):
    rows = []
    for i in range(30):
        lat, lon = 37.776 + i % 5 * 0.002, -122.414 + i % 3 * 0.003
        rows.append((i, lat, lon, [50.0, 300.0, 900.0][i % 3], "MonTueSun"[i % 3 * 3:][:3], f"{9 + i % 9}:00"))
    rows += [(100 + i, *PLACE, "mon", "11:00") for i in range(20)]
    rows += [
        (200, None, None, 100.0, "Mon", "11:00"),
        (201, *PLACE, "Xyz", "11:00"),
        (202, *PLACE, "Mon", "noon"),
        (203, *PLACE, "Mon", "18:00"),
        (204, *PLACE, None, None),
        (205, PLACE[0], PLACE[1], None, "Mon", "11:00"),
        (206, 10.0, 10.0, 100.0, "Mon", "11:00"),
    ]
    return rows, spark.createDataFrame(
        rows, "request_id long, lat double, lon double, metres double, day string, time string"
    )


def test_scores_of_many_requests(spark, data):
    sessions, meters, plain, inventory = data
    rows, requests = requests_table(spark)
    got = {r[0]: tuple(r)[1:] for r in cb.score_requests(requests, sessions, meters).collect()}
    assert len(got) == len(rows)
    for key, lat, lon, radius, day, time in rows:
        n = 0 if None in (lat, radius) else len(near(inventory, lat, lon, radius))
        average = None
        if key < 200:
            hour = int(time.split(":")[0])
            average = mean(
                meters_per_date(plain, inventory, lat, lon, radius, day.capitalize(), hour).values()
            )
        occupied = None if average is None else round(average)
        assert got[key] == (
            average if average is None else pytest.approx(average),
            occupied,
            n,
            f"Historical Occupancy = {occupied}/{n}",
        )


def test_possibilities_of_many_requests(spark, data):
    sessions, meters, *_ = data
    pivot = cb.hour_pivot(sessions)
    rows, requests = requests_table(spark)
    scored = cb.score_possibility(requests, pivot, meters, 14)
    got = {r[0]: tuple(r)[1:] for r in scored.collect()}
    assert len(got) == len(rows)
    for key, lat, lon, radius, _, time in [*rows[:4], rows[35]]:
        hour = int(time.split(":")[0])
        one = cb.area_possibility(pivot, meters, lat, lon, radius, hour, 14).first()
        assert got[key] == tuple(one)
    assert got[200] == got[205] == (None, 0, 0, "None")
    assert got[201][0] is not None
    assert got[202][0] is got[203][0] is None
    assert got[203][1] == got[100][1]


def test_bad_requests_are_refused(data):
    sessions, meters, *_ = data
    with pytest.raises(ValueError):
        cb.avg_sessions_at(sessions, meters, *PLACE, "Mon", "9:00:00")
    with pytest.raises(ValueError):
        cb.avg_meters_in_hour(sessions, meters, *PLACE, "Noday", 11)
    for hour in (8, 18):
        with pytest.raises(ValueError):
            cb.avg_meters_in_hour(sessions, meters, *PLACE, "Mon", hour)


def test_pivot_with_other_hours_can_be_read(spark):
    sessions = fixtures.typed_sessions(spark, SMALL)
    pivot = cb.hour_pivot(sessions, range(8, 21), 8, 20)
    assert cb.pivot_hours(pivot) == list(range(8, 21))
    assert cb.hour_column(pivot, 8).columns == ["POST_ID", "n_days"]
    with pytest.raises(ValueError):
        cb.hour_column(pivot, 21)
    requests = cb.locate(fixtures.requests(spark, SMALL), fixtures.gazetteer(spark, SMALL))
    meters = fixtures.meters(spark, SMALL)
    short = cb.hour_pivot(sessions, [9, 10])
    rows = cb.score_possibility(requests, short, meters, 19).collect()
    assert len(rows) == requests.count()


def test_batch_rows_equal_the_answers_for_one_request(spark):
    sessions, meters = fixtures.typed_sessions(spark, SMALL), fixtures.meters(spark, SMALL)
    asked = spark.createDataFrame(
        [(1, 37.779, -122.41, 900.0, "Mon", "11:00")],
        "request_id int, lat double, lon double, metres double, day string, time string",
    )
    def rows(df):
        return sorted(tuple(r) for r in df.collect())

    days = cb.score_meter_days(asked, sessions, meters).drop("request_id")
    one = cb.occupied_days_by_meter(sessions, meters, 37.779, -122.41, 900.0, "Mon", 11)
    assert rows(days.select(*one.columns)) == rows(one) != []
    pivot = cb.hour_pivot(sessions)
    chances = cb.score_meter_possibility(asked, pivot, meters, 19).drop("request_id")
    single = cb.meter_possibility(pivot, meters, 37.779, -122.41, 900.0, 11, 19)
    assert rows(chances.select(*single.columns)) == rows(single) != []


def test_pairs_of_requests_and_meters_are_not_shuffled(spark, never_broadcast):
    """They grow with the product of both tables; what comes before grows with their sum."""
    sessions, meters = fixtures.typed_sessions(spark, SMALL), fixtures.meters(spark, SMALL)
    asked = cb.locate(fixtures.requests(spark, SMALL), fixtures.gazetteer(spark, SMALL))
    pivot = cb.hour_pivot(sessions)
    for scored in (
        cb.score_meter_days(asked, sessions, meters),
        cb.score_meter_possibility(asked, pivot, meters, 19),
    ):
        lines = scored._jdf.queryExecution().executedPlan().toString().splitlines()
        above = next(i for i, line in enumerate(lines) if "Join" in line)
        assert "__cell" in lines[above]
        assert not any("Exchange" in line for line in lines[:above])


def test_equal_requests_get_equal_rows(spark):
    sessions, meters = fixtures.typed_sessions(spark, SMALL), fixtures.meters(spark, SMALL)
    pivot = cb.hour_pivot(sessions)
    place = (37.779, -122.41, 900.0, "Mon", "11:00")
    odd = [(None, -122.41, 900.0, "Mon", "11:00"), (37.779, -122.41, None, "Mon", "11:00"),
           (37.779, -122.41, 900.0, None, "11:00"), (37.779, -122.41, 900.0, "Mon", "23:00")]
    names = "request_id int, lat double, lon double, metres double, day string, time string"
    many = [(i, *place) for i in range(300)] + [(None, *place), (7, *place)]
    many = spark.createDataFrame(many + [(900 + i, *row) for i, row in enumerate(odd)], names)
    one = spark.createDataFrame([(1, *place)], names)
    for rows, single in (
        (cb.score_meter_days(many, sessions, meters), cb.score_meter_days(one, sessions, meters)),
        (cb.score_meter_possibility(many.where("day = 'Mon'"), pivot, meters, 19),
         cb.score_meter_possibility(one, pivot, meters, 19)),
    ):
        n = single.count()
        per_request = {r.request_id: r["count"] for r in rows.groupBy("request_id").count().collect()}
        assert n > 0 and per_request == dict.fromkeys([None, *range(300)], n) | {7: 2 * n}
        assert rows.drop("request_id").distinct().count() == n


DATED = "POST_ID string, Day_Of_Week string, EventDate string, StartTime string, EndTime string, start_hour int, end_hour int"


def test_averages_over_empty_days(spark):
    """Mondays from 1 January 2024 on; the sessions are on two of them."""
    at = ("10:00:00", "12:00:00", 10, 12)
    sessions = spark.createDataFrame(
        [("m", "Mon", "2024-01-01", *at), ("m", "Mon", "2024-01-01", *at),
         ("m", "Mon", "2024-01-15", *at), ("m", "Tue", "2024-01-23", *at),
         ("m", None, None, None, None, None, None)], DATED,
    )
    meters = spark.createDataFrame([("m", 1.0, 1.0)], "POST_ID string, latitude double, longitude double")
    here = (sessions, meters, 1.0, 1.0, 10.0, "mon")

    def average(**more):
        return cb.avg_sessions_at(*here, "11:00:00", **more).first().avg_sessions

    assert average() == 1.5
    assert average(include_empty_days=True) == 3 / 4
    assert average(include_empty_days=True, last="2024-02-05") == 3 / 6
    assert average(include_empty_days=True, first="2024-01-02", last="2024-01-21") == 1 / 2
    assert average(include_empty_days=True, first="2024-02-01", last="2024-01-01") is None
    row = cb.avg_meters_in_hour(*here, 11, include_empty_days=True).first()
    assert row.avg_meters == 2 / 4 and row.occupied == 0 and row.n_meters == 1
    empty = sessions.limit(0)
    none = cb.avg_sessions_at(empty, *here[1:], "11:00:00", include_empty_days=True).first()
    assert none.avg_sessions is None
