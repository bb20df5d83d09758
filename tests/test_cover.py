import math
import random

import pytest
from brute import near
from pyspark.sql import functions as F

import curbside as cb
from curbside.operators.cover import PLACE, SPOT, UNIT, cover

PLACES = "lat double, lon double, metres double"
SPOTS = "latitude double, longitude double"


def covered(spark, places, spots, **more):
    units, members = cover(
        spark.createDataFrame(places, PLACES), spark.createDataFrame(spots, SPOTS), **more
    )
    pairs = units.join(members, UNIT).select(*PLACE, *SPOT)
    return sorted(map(tuple, pairs.collect())), units


def expected(places, spots):
    found = set()
    for place in set(places):
        if None in place or not place[2] >= 0:
            continue
        ids = near([(i, *s) for i, s in enumerate(spots) if None not in s], *place)
        found |= {(*place, *spot[1:]) for spot in ids}
    return sorted(found)


@pytest.mark.parametrize("cell_spots,few_spots", [(2, 0), (32, 0), (32, 4096)])
def test_circles_all_over_the_earth(spark, cell_spots, few_spots):
    rng = random.Random(11)
    places = [
        (rng.uniform(-90, 90), rng.uniform(-180, 180), 10 ** rng.uniform(0, 7.3))
        for _ in range(40)
    ]
    places += [(rng.uniform(-80, 80), 180.0, 10 ** rng.uniform(1, 6)) for _ in range(10)]
    places += [(89.99, 3.0, 30_000.0), (-90.0, 0.0, 500.0), (10.0, 10.0, 0.0)]
    places += [(None, 1.0, 5.0), (1.0, None, 5.0), (1.0, 1.0, None), (1.0, 1.0, -1.0)]
    places += [(1.0, 1.0, float("nan")), places[0]]
    spots = [(10.0, 10.0), (90.0, 0.0), (-90.0, 5.0), (0.0, 180.0), (0.0, -180.0)]
    spots += [(None, 1.0), (1.0, None)]
    for lat, lon, radius in places[:50]:
        for _ in range(15):
            reach = 1.1 * radius / 111_195
            at = max(-90.0, min(90.0, lat + rng.uniform(-reach, reach)))
            wide = reach / max(0.01, math.cos(math.radians(at)))
            spots.append((at, (lon + rng.uniform(-wide, wide) + 180) % 360 - 180))
    found, _ = covered(spark, places, spots, cell_spots=cell_spots, few_spots=few_spots)
    assert found == expected(places, spots)


def test_units_grow_with_the_rim(spark):
    """Four times the positions in a circle: about twice the units."""
    counts = []
    for side in (100, 200, 400):
        grid = spark.range(side * side).select(
            (37.7 + (F.col("id") % side) * (0.1 / side)).alias("latitude"),
            (-122.5 + F.floor(F.col("id") / side) * (0.1 / side)).alias("longitude"),
        )
        place = spark.createDataFrame([(37.75, -122.45, 4000.0)], PLACES)
        units, members = cover(place, grid, cell_spots=4)
        inside = units.join(members, UNIT).count()
        exact = cb.distance_join(place, grid).count()
        assert inside == exact
        counts.append((exact, units.join(members.select(*UNIT).distinct(), UNIT).count()))
    (held, first), _, (many, last) = counts
    assert many > 15 * held
    assert last < 6 * first and last < many / 8


def test_no_circles_and_no_positions(spark):
    assert covered(spark, [], [(1.0, 1.0)])[0] == []
    assert covered(spark, [(1.0, 1.0, 5.0)], [])[0] == []
