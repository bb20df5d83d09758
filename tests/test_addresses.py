import random

import pytest

import curbside as cb
from curbside.operators.addresses import LETTERS_PER_EDIT

GAZETTEER = "address string, lat double, lon double"
STREETS = ["Market", "Mission", "Valencia", "Folsom", "Howard", "Geary", "Lombard", "Castro"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(text):
    kept = "".join(c if c.isalnum() else " " for c in (text or "").lower())
    return " ".join(kept.split())


def brute(text, places, most=3):
    p = plain(text)
    found = [
        (d, plain(a), lat, lon, a) for a, lat, lon in places
        if plain(a) and p
        for d in [distance(p, plain(a))] if d <= min(most, len(p) // LETTERS_PER_EDIT)
    ]
    if not found:
        return None, None, None, None
    d, _, lat, lon, a = min(found)
    return lat, lon, a, d


def mangled(rng, text):
    letters = list(text)
    for _ in range(rng.randrange(5)):
        at = rng.randrange(len(letters) + 1)
        kind = rng.randrange(4)
        if kind == 0:
            letters.insert(at, rng.choice("abcxyz 1"))
        elif letters and kind == 1:
            letters.pop(at % len(letters))
        elif letters and kind == 2:
            letters[at % len(letters)] = rng.choice("abcxyz")
        elif len(letters) > 1:
            at %= len(letters) - 1
            letters[at], letters[at + 1] = letters[at + 1], letters[at]
    return "".join(letters)


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_equals_comparing_with_every_address(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    rng = random.Random(7)
    places = [(f"{n} {s} Street", 37.0 + n / 1e4, -122.0 - i / 1e3)
              for i, s in enumerate(STREETS) for n in range(1, 40, 3)]
    places += [("1 Market Street", 36.0, -121.0), ("Ōsaka-jō", 1.0, 2.0), ("Pier 39", 3.0, 4.0),
               ("aaaaaaaa", 5.0, 6.0), ("aaaa", 7.0, 8.0), ("", 9.0, 9.0), (None, 9.0, 9.0)]
    asked = [mangled(rng, rng.choice(places[:-2])[0]) for _ in range(150)]
    asked += ["1, MARKET  street!", None, "", "?!", "zzz", "aaa", "aaaaaaaaaa", "pier39", "osaka jo"]
    requests = spark.createDataFrame(list(enumerate(asked)), "request_id long, address string")
    got = cb.locate_text(requests, spark.createDataFrame(places, GAZETTEER)).collect()
    assert len(got) == len(asked)
    for r in got:
        assert (r.lat, r.lon, r.found_address, r.edits) == brute(r.address, places), r.address
    assert sum(r.edits is not None and r.edits > 0 for r in got) > 60


def test_empty_tables(spark):
    none = spark.createDataFrame([], "request_id long, address string")
    places = spark.createDataFrame([("Pier 39", 3.0, 4.0)], GAZETTEER)
    assert cb.locate_text(none, places).collect() == []
    one = spark.createDataFrame([(1, "Pier 39")], "request_id long, address string")
    assert cb.locate_text(one, places.limit(0)).first().lat is None
