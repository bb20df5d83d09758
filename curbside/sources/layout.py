"""Tables stored in the order of a curve through all places of the earth.

Places close to each other lie close on the curve, so a circle is a few ranges
of it. Files hold ranges, and the bounds that Parquet keeps for each row group
let a scan skip all that lies outside.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.functions.geo import EARTH_RADIUS_M
from curbside.operators.joins import salt_of_row
from curbside.operators.spatial import within_distance

KEY = "place_key"
# Rows and columns of the grid that the curve runs through: two to this power.
BITS = 20
# Ranges that a circle is made of at most; each is a filter of the scan.
RANGES = 32

_SIDE = 1 << BITS


def _spread(number: str) -> str:
    """The bits of a number with a zero in front of each: read base two as base four."""
    return f"CAST(conv(bin({number}), 4, 10) AS BIGINT)"


def place_key(latitude: str = "latitude", longitude: str = "longitude") -> Column:
    """Place on the curve of two columns of degrees; NULL without a position."""
    row = f"least(greatest(floor(({latitude} + 90) / 180 * {_SIDE}), 0L), {_SIDE - 1}L)"
    cell = f"pmod(floor(({longitude} + 180) / 360 * {_SIDE}), {_SIDE}L)"
    key = f"2 * {_spread(row)} + {_spread(cell)}"
    return F.expr(f"CASE WHEN {latitude} IS NOT NULL AND {longitude} IS NOT NULL THEN {key} END")


def _box(lat: float, lon: float, metres: float) -> list[tuple[int, int, int, int]]:
    """First and last row and column of the grid around a circle, cut at the date line.

    One row and column more on each side than the circle has.
    """
    reach = math.degrees(metres / EARTH_RADIUS_M)
    south, north = (
        min(_SIDE - 1, max(0, math.floor((lat + sign * reach + 90) / 180 * _SIDE) + sign))
        for sign in (-1, 1)
    )
    if abs(lat) + reach >= 90:
        return [(south, north, 0, _SIDE - 1)]
    ratio = math.sin(math.radians(reach)) / math.cos(math.radians(lat))
    width = math.degrees(math.asin(min(1.0, ratio)))
    west, east = (
        math.floor((lon + sign * width + 180) / 360 * _SIDE) + sign for sign in (-1, 1)
    )
    if east - west >= _SIDE - 1:
        return [(south, north, 0, _SIDE - 1)]
    west, east = west % _SIDE, east % _SIDE
    if west <= east:
        return [(south, north, west, east)]
    return [(south, north, west, _SIDE - 1), (south, north, 0, east)]


def curve_ranges(
    lat: float, lon: float, metres: float, most: int = RANGES
) -> list[tuple[int, int]]:
    """Ranges of the curve that hold every place of a circle, ``most`` at most.

    Squares are cut in four, largest first, until they lie in the box around
    the circle or there are enough of them; neighbours on the curve are joined.
    """
    boxes = _box(lat, lon, metres)

    def parts(level: int, row: int, cell: int) -> tuple[bool, bool]:
        """Whether a square meets a box, and whether it lies in one."""
        size = 1 << (BITS - level)
        s, n, w, e = row * size, (row + 1) * size - 1, cell * size, (cell + 1) * size - 1
        meets = [b for b in boxes if s <= b[1] and n >= b[0] and w <= b[3] and e >= b[2]]
        return bool(meets), any(
            b[0] <= s and n <= b[1] and b[2] <= w and e <= b[3] for b in meets
        )

    # Squares as level, row, cell and the number that the curve gives them.
    squares, done = [(0, 0, 0, 0)], []
    while squares and len(squares) + len(done) + 3 <= 4 * most:
        level, row, cell, number = squares.pop(0)
        if level == BITS or parts(level, row, cell)[1]:
            done.append((level, number))
            continue
        for part in range(4):
            child = level + 1, 2 * row + part // 2, 2 * cell + part % 2, 4 * number + part
            if parts(*child[:3])[0]:
                squares.append(child)
    done += [(level, number) for level, _, _, number in squares]
    spans = sorted(
        (number << 2 * (BITS - level), ((number + 1) << 2 * (BITS - level)) - 1)
        for level, number in done
    )
    joined: list[tuple[int, int]] = []
    for first, last in spans:
        if joined and first == joined[-1][1] + 1:
            joined[-1] = joined[-1][0], last
        else:
            joined.append((first, last))
    while len(joined) > most:
        # Close the smallest gap.
        gap = min(range(1, len(joined)), key=lambda i: joined[i][0] - joined[i - 1][1])
        joined[gap - 1 : gap + 1] = [(joined[gap - 1][0], joined[gap][1])]
    return joined


def write_by_place(
    df: DataFrame,
    path: str,
    by_weekday: bool = False,
    mode: str = "overwrite",
    files: int | None = None,
    row_group_bytes: int | None = None,
) -> None:
    """Write rows with ``latitude`` and ``longitude`` in the order of the curve.

    The table gets the column ``place_key``. ``by_weekday`` makes a folder for
    each weekday. A place with very many rows is dealt over several files. Rows
    without a position come first and are not lost. ``files`` is about how many
    are written, by default the session's shuffle partitions, and
    ``row_group_bytes`` the size of what a scan can skip.
    """
    spark = df.sparkSession
    parts = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    days = ["Day_Of_Week"] if by_weekday else []
    keyed = df.withColumn(KEY, place_key()).withColumn("__salt", salt_of_row(df, 1 << 30))
    writer = (
        keyed.repartitionByRange(parts, *days, KEY, "__salt")
        .drop("__salt")
        .sortWithinPartitions(*days, KEY)
        .write.partitionBy(*days)
        .mode(mode)
    )
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", row_group_bytes)
    writer.parquet(path)


def read_within(
    spark: SparkSession, path: str, lat: float, lon: float, metres: float
) -> DataFrame:
    """The rows of a table by place within ``metres`` of a point, border included.

    Files and row groups outside the ranges of the circle are skipped; the exact
    distance decides on the rest.
    """
    inside = F.lit(False)
    for first, last in curve_ranges(lat, lon, metres):
        inside |= F.col(KEY).between(first, last)
    rows = spark.read.parquet(path).where(inside)
    return within_distance(rows, lat, lon, metres)
