import random

import pytest
from brute import mean, near, sessions_per_date

import curbside as cb
from compare import spark_rows
from conftest import SMALL
from curbside import fixtures
from curbside.catalog import DAY, PLACE

SESSIONS = (
    "POST_ID string, Day_Of_Week string, EventDate string, StartTime string, EndTime string"
)
METERS = "POST_ID string, latitude double, longitude double"
REQUESTS = "request_id long, lat double, lon double, metres double, day string, time string"
DATES = {"Mon": ("2024-01-01", "2024-01-08"), "Tue": ("2024-01-02",), "Sun": ("2024-01-07",)}


def clock(rng, first=0, last=86_399):
    s = rng.randint(first, last)
    return f"{s // 3600:02d}:{s // 60 % 60:02d}:{s % 60:02d}"


def data(seed, n=400):
    rng = random.Random(seed)
    meters = [
        (str(i), 37.77 + rng.randrange(12) * 0.001, -122.42 + rng.randrange(12) * 0.001)
        for i in range(40)
    ]
    meters += [meters[0], meters[1], (meters[2][0], 37.775, -122.415), (None, 37.775, -122.415)]
    meters += [("far", 10.0, 10.0), ("none", None, -122.4)]
    sessions = []
    for _ in range(n):
        day = rng.choice(list(DATES))
        # A third of all sessions are of one meter.
        post = "0" if rng.random() < 0.33 else str(rng.randrange(45))
        start = clock(rng, 30_000, 40_000)
        end = clock(rng, 30_000, 45_000) if rng.random() < 0.8 else clock(rng)
        sessions.append((post, day, rng.choice(DATES[day]), start, end))
    sessions += [(None, "Mon", "2024-01-01", "00:00:00", "23:59:59"),
                 ("0", None, None, None, None), ("0", "Mon", "2024-01-01", "10:00:00", None),
                 ("0", "Mon", "2024-01-01", "00:00:00", "23:59:59"),
                 ("0", "Mon", "2024-01-01", "10:00:00", "10:00:01"),
                 ("0", "Mon", "2024-01-01", "10:00:00", "10:00:00")]
    times = ["10:00:00", "10:00:01", "09:59:59", "00:00:00", "23:59:59", "11:00"]
    times += [clock(rng, 30_000, 45_000) for _ in range(6)]
    requests = [
        (i, 37.775 + rng.uniform(-0.004, 0.004), -122.415, rng.choice([0.0, 150.0, 600.0, 1e6]),
         rng.choice(["mon", "Tue", "SUN", "Wed"]), times[i % len(times)])
        for i in range(48)
    ]
    return sessions, meters, requests


def answer(sessions, meters, request):
    _, lat, lon, radius, day, time = request
    rows = [dict(zip(("POST_ID", "Day_Of_Week", "EventDate", "StartTime", "EndTime"), s))
            for s in sessions if None not in s]
    time = time if len(time) == 8 else time + ":00"
    known = [m for m in meters if m[0] is not None]
    per_date = sessions_per_date(rows, known, lat, lon, radius, day.capitalize(), time)
    return mean(per_date.values()), len(near(meters, lat, lon, radius))


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_matches_brute_force(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    sessions, meters, requests = data(5)
    rows = cb.score_in_progress(
        spark.createDataFrame(requests, REQUESTS),
        spark.createDataFrame(sessions, SESSIONS),
        spark.createDataFrame(meters, METERS),
    ).collect()
    got = {r.request_id: (r.avg_sessions, r.n_meters) for r in rows}
    assert len(rows) == len(requests)
    for request in requests:
        want = answer(sessions, meters, request)
        assert got[request[0]][1] == want[1]
        assert got[request[0]][0] == (pytest.approx(want[0]) if want[0] is not None else None)
    assert sum(v[0] is not None for v in got.values()) > 10


def test_unanswerable_requests_keep_their_rows(spark):
    sessions, meters, _ = data(6, 50)
    at = (37.775, -122.415, 500.0)
    requests = [
        (1, None, -122.4, 500.0, "Mon", "10:00"), (2, *at, "someday", "10:00"),
        (3, *at, "Mon", "25:00"), (4, *at, "Mon", None), (5, *at, None, "10:00"),
        (6, *at, "Mon", "noon"), (7, 0.0, 0.0, 5.0, "Mon", "10:00"), (8, *at, "Mon", "9:00"),
    ]
    rows = cb.score_in_progress(
        spark.createDataFrame(requests, REQUESTS),
        spark.createDataFrame(sessions, SESSIONS),
        spark.createDataFrame(meters, METERS),
    ).collect()
    assert sorted(r.request_id for r in rows) == list(range(1, 9))
    assert all(r.avg_sessions is None and r.label.endswith(f"None/{r.n_meters}") for r in rows)


@pytest.mark.parametrize("time", ["11:00:00", "09:30:17"])
def test_one_request_is_the_query_for_one_place(spark, time):
    sessions, meters = fixtures.typed_sessions(spark, SMALL), fixtures.meters(spark, SMALL)
    request = spark.createDataFrame([(1, *PLACE, DAY, time)], REQUESTS)
    many = cb.score_in_progress(request, sessions, meters).drop("request_id")
    assert spark_rows(many) == spark_rows(cb.avg_sessions_at(sessions, meters, *PLACE, DAY, time))


def test_no_task_sees_a_meter_as_a_whole(spark):
    """A meter with all sessions, and few clocks asked: few rows are left of it."""
    sessions = [("0", "Mon", "2024-01-01", f"10:00:{i % 60:02d}", "10:30:00")
                for i in range(5000)]
    from curbside.plans.in_progress import _asked, _by_hour, _changes

    request = [(1, 37.775, -122.415, 500.0, "Mon", "10:00:30"),
               (2, 37.775, -122.415, 500.0, "Mon", "10:15:00")]
    asked = _asked(spark.createDataFrame(request, REQUESTS))
    changes = _changes(spark.createDataFrame(sessions, SESSIONS), asked)
    assert changes.count() == 2
    assert _by_hour(changes, "POST_ID", "EventDate").count() <= 2 + 13
