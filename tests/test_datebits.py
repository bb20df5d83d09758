import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import curbside as cb
from curbside import fixtures
from curbside.operators.datebits import ANY_HOUR
from conftest import SMALL

SESSIONS = "POST_ID string, Day_Of_Week string, EventDate string, start_hour int, end_hour int"


def rows(seed, n=400):
    rng, out = random.Random(seed), []
    for _ in range(n):
        day = date(1969, 10, 1) + timedelta(days=rng.choice([rng.randrange(260), rng.randrange(20_000)]))
        start = rng.randrange(6, 20)
        out.append((rng.choice(["a", "b", "c", None]), day.strftime("%a"), day.isoformat(), start,
                    start + rng.randrange(4)))
    return out + [("a", None, None, 10, 11), ("a", "Mon", "no date", 10, 11)]


@pytest.mark.parametrize("day", [None, "sun", "Thu"])
def test_any_range_equals_counting_sessions(spark, tmp_path, day):
    data = rows(3)
    sessions = spark.createDataFrame(data, SESSIONS)
    path = str(tmp_path / "bits")
    cb.append_date_bits(sessions.where("EventDate IS NULL OR EventDate < '1990'"), path)
    cb.append_date_bits(sessions.where("EventDate >= '1980'"), path)
    bits = cb.read_date_bits(spark, path)
    rng = random.Random(4)
    ranges = [("1969-01-01", "2100-01-01"), ("1970-01-01", "1970-01-01"), ("2000-01-02", "2000-01-01")]
    for _ in range(6):
        ends = sorted(date(1969, 10, 1) + timedelta(days=rng.randrange(400)) for _ in range(2))
        ranges.append(tuple(d.isoformat() for d in ends))
    for first, last in ranges:
        inside = [r for r in data if r[2] and first <= r[2] <= last and r[2] != "no date"
                  and day in (None, r[1].lower() if day == "sun" else r[1])]
        hour = rng.randrange(9, 18)
        want = {}
        for post, _, when, start, end in inside:
            if post and 9 <= start <= hour <= end <= 17:
                want.setdefault(post, set()).add(when)
        got = cb.occupied_days_between(bits, hour, first, last, day).collect()
        assert {r.POST_ID: r.n_days for r in got} == {p: len(d) for p, d in want.items()}
        seen = cb.observed_days_between(bits, first, last, day).first().n_days
        assert seen == len({r[2] for r in inside})


def test_equals_occupied_days_of_the_log(spark):
    sessions = fixtures.typed_sessions(spark, SMALL)
    bits = cb.date_bits(cb.occupancy(sessions))
    kept = cb.occupied_in_hour(sessions, 12).where("EventDate BETWEEN '2024-01-10' AND '2024-01-20'")
    got = cb.occupied_days_between(bits, 12, "2024-01-10", "2024-01-20")
    assert sorted(got.collect()) == sorted(cb.occupied_days(kept).collect())
    assert bits.where(F.col("hour") == ANY_HOUR).count() > 0
