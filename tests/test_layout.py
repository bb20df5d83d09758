import random
from collections import Counter

import pytest
from brute import near
from pyspark.sql import functions as F

import curbside as cb
from curbside.sources.layout import BITS, RANGES, curve_ranges, place_key

METERS = "POST_ID string, latitude double, longitude double"


def plain_key(lat, lon):
    """Bits of row and column in turn."""
    side = 1 << BITS
    row = min(max(int((lat + 90) / 180 * side // 1), 0), side - 1)
    cell = int((lon + 180) / 360 * side // 1) % side
    return sum((row >> b & 1) << 2 * b + 1 | (cell >> b & 1) << 2 * b for b in range(BITS))


def scanned(df):
    """Rows that left the scan, after what Parquet's bounds let it skip."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def test_ranges_hold_every_place_of_the_circle():
    rng = random.Random(2)
    for _ in range(60):
        lat, lon = rng.uniform(-90, 90), rng.uniform(-180, 180)
        radius = 10 ** rng.uniform(0, 7.2)
        ranges = curve_ranges(lat, lon, radius)
        assert 0 < len(ranges) <= RANGES
        assert all(a <= b for a, b in ranges)
        reach = radius / 100_000
        spots = [
            (str(i), max(-90.0, min(90.0, lat + rng.uniform(-reach, reach))),
             (lon + rng.uniform(-2, 2) * reach + 180) % 360 - 180)
            for i in range(200)
        ]
        for _, a, b in near(spots, lat, lon, radius):
            key = plain_key(a, b)
            assert any(first <= key <= last for first, last in ranges)


def test_keys_are_interleaved_bits(spark):
    rng = random.Random(3)
    spots = [("a", rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(50)]
    spots += [("p", 90.0, 180.0), ("s", -90.0, -180.0), ("n", None, 1.0), ("m", 1.0, None)]
    for r in spark.createDataFrame(spots, METERS).withColumn("k", place_key()).collect():
        none = r.latitude is None or r.longitude is None
        assert r.k == (None if none else plain_key(r.latitude, r.longitude))


def test_small_circle_skips_most_row_groups(spark, tmp_path):
    city = spark.range(90_000).select(
        F.col("id").cast("string").alias("POST_ID"),
        (37.6 + (F.col("id") % 300) * 0.001).alias("latitude"),
        (-122.6 + F.floor(F.col("id") / 300) * 0.001).alias("longitude"),
    )
    path = str(tmp_path / "meters")
    cb.write_by_place(city, path, files=30)
    here = (37.75, -122.45, 500.0)
    found = cb.read_within(spark, path, *here)
    assert 0 < scanned(found) < 90_000 / 8
    assert {r[0] for r in found.select("POST_ID").collect()} == {
        r[0] for r in cb.meters_within(city, *here).select("POST_ID").collect()
    }


@pytest.mark.parametrize("by_weekday", [False, True])
def test_nothing_is_lost_and_a_hot_place_is_dealt_out(spark, tmp_path, by_weekday):
    rng = random.Random(4)
    rows = [("Mon", 37.77, -122.41)] * 400
    rows += [(rng.choice(["Mon", "Tue", None]), rng.uniform(37, 38), -122.0) for _ in range(500)]
    rows += [("Tue", None, -122.0), (None, None, None)]
    df = spark.createDataFrame(rows, "Day_Of_Week string, latitude double, longitude double")
    path = str(tmp_path / "rows")
    cb.write_by_place(df, path, by_weekday=by_weekday, files=8)
    back = spark.read.parquet(path)
    assert Counter(map(tuple, back.select(*df.columns).collect())) == Counter(rows)
    hot = back.where("latitude = 37.77 AND longitude = -122.41")
    assert hot.select(F.col("_metadata.file_path")).distinct().count() > 1
    assert cb.read_within(spark, path, 37.77, -122.41, 0.0).count() == 400


def test_date_line_and_poles(spark, tmp_path):
    spots = [("a", 10.0, 179.9995), ("b", 10.0, -179.9995), ("c", 89.9999, 5.0),
             ("d", 89.9999, -175.0), ("e", 10.0, 0.0)]
    path = str(tmp_path / "spots")
    cb.write_by_place(spark.createDataFrame(spots, METERS), path, files=3)
    for lat, lon, radius in ((10.0, 180.0, 200.0), (10.0, -180.0, 200.0), (90.0, 0.0, 50.0)):
        got = {r.POST_ID for r in cb.read_within(spark, path, lat, lon, radius).collect()}
        assert got == {m[0] for m in near(spots, lat, lon, radius)} and len(got) == 2
