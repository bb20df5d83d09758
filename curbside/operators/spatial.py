"""Radius search, the distance join and the address lookup."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.geo import (
    AROUND,
    CELL,
    CELLS,
    LEVEL,
    ROW,
    ROWS,
    SPHERE_MARGIN,
    box_around,
    geodesic_m,
    haversine_m,
)
from curbside.operators.joins import (
    bytes_of_rows,
    fits_broadcast,
    gathered,
    is_small,
    lookup_join,
    salt_of_row,
)
from curbside.scratch import stored

_CELL = ["__level", "__row", "__cell"]

_PLACE = ["lat", "lon", "metres"]
_SPOT = ["latitude", "longitude"]

# Points, and meters, of one cell that a single task may get.
CELL_ROWS = 10_000
# Rows and pairs that a task of the shuffled join is to have, about, and the
# number of tasks beyond which they get more.
TASK_ROWS = 250_000
TASK_PAIRS = 20_000_000
MOST_TASKS = 20_000
# Bytes of a row group of lists: a reader unpacks up to 4,096 lists at once, but
# none beyond a row group.
LISTS_GROUP = 1 << 21


def within_distance(
    df: DataFrame, lat: float, lon: float, metres: float, spheroid: bool = False
) -> DataFrame:
    """Rows whose ``latitude``/``longitude`` lie within ``metres`` of a point.

    The border belongs to the circle. The bounding box is a range on the plain
    columns, so a Parquet scan can skip row groups; the distance is the rest.
    ``spheroid`` measures on the spheroid, after a slightly larger circle on the
    sphere has sorted out most rows.
    """
    here = F.col("latitude"), F.col("longitude")
    wide = metres * SPHERE_MARGIN + 1 if spheroid else metres
    on_sphere = haversine_m(float(lat), float(lon), "latitude", "longitude")
    near = df.where(box_around(lat, lon, wide, *here)).where(on_sphere <= wide)
    if not spheroid:
        return near
    return near.where(geodesic_m(float(lat), float(lon), "latitude", "longitude") <= metres)


def meters_within(
    meters: DataFrame, lat: float, lon: float, metres: float, spheroid: bool = False
) -> DataFrame:
    """Position and distance of the meters within a radius."""
    measure = geodesic_m if spheroid else haversine_m
    distance = measure(float(lat), float(lon), "latitude", "longitude")
    return within_distance(meters, lat, lon, metres, spheroid).select(
        "POST_ID", "latitude", "longitude", distance.alias("metres")
    )


def _survey(points: DataFrame) -> tuple[list[int], int, int]:
    """Cell levels of the radii, at most twenty small numbers, the size, the longest list."""
    levels = F.expr(f"bit_or(shiftleft(1, {LEVEL}))")
    found = points.agg(
        levels, bytes_of_rows(points, lists=True), F.max(F.size("__points"))
    ).first()
    bits, size, longest = found[0] or 1, found[1], found[2] or 0
    return [k for k in range(bits.bit_length()) if bits >> k & 1], size, longest


def _on_demand(rows: str) -> Column:
    """A list for ``inline``, whose rows are then made one by one as they are asked for.

    Compiled code holds all that one row it reads leads to, over joins and
    generators: a list of points times all meters of a cell. A lambda is not
    compiled, so that the code of the join and that after the list are apart.
    """
    return F.transform(rows, lambda row: row)


def _looking(points: DataFrame) -> DataFrame:
    """Points, once for every cell that their circle touches."""
    return (
        points.selectExpr("*", f"{LEVEL} AS __level")
        .selectExpr("*", f"explode({ROWS}) AS __row")
        .selectExpr("*", f"{AROUND} AS __around")
        .selectExpr("*", f"explode({CELLS}) AS __cell")
        .drop("__around")
    )


def _placed(meters: DataFrame, levels: list[int]) -> DataFrame:
    """Meters with their cell, once for every level in use."""
    return (
        meters.selectExpr("*", f"explode(array({', '.join(map(str, levels))})) AS __level")
        .selectExpr("*", f"{ROW} AS __row")
        .selectExpr("*", f"{AROUND} AS __around")
        .selectExpr("*", f"{CELL} AS __cell")
        .drop("__around")
    )


def _rows_of(df: DataFrame, name: str) -> Column:
    """Rows that a list leads to: a point may be a list of requests in turn."""
    row = df.schema[name].dataType.elementType
    if "__rows" not in row.names:
        return F.size(name)
    return F.aggregate(name, F.lit(0), lambda n, x: n + F.greatest(F.size(x["__rows"]), F.lit(1)))


def _dealt(looking: DataFrame, placed: DataFrame, cell_rows: int) -> DataFrame:
    """Points and meters of the same cell, with crowded cells cut into parts.

    Tasks are as many as the pairs need that they have to make: the shuffled
    rows are few beside those, so their bytes would not tell.
    """
    sides = ((looking, "__points"), (placed, "__meters"))
    counts = [
        df.groupBy(*_CELL).agg(F.sum(_rows_of(df, n)).alias(f"{n}_n")) for df, n in sides
    ]
    cells = stored(counts[0].join(counts[1], _CELL), "cells")
    n_points, n_meters = F.col("__points_n"), F.col("__meters_n")
    rows, pairs = cells.agg(
        F.sum(n_points + n_meters), F.sum(n_points.cast("double") * n_meters)
    ).first()
    tasks = math.ceil((rows or 0) / TASK_ROWS + (pairs or 0) / TASK_PAIRS)
    tasks = max(1, min(tasks, MOST_TASKS))
    parts = cells.where((n_points > cell_rows) | (n_meters > cell_rows)).select(
        *_CELL,
        *[
            F.ceil(F.col(f"{n}_n") / cell_rows).cast("int").alias(f"{n}_part")
            for _, n in sides
        ],
    )
    if parts.isEmpty():
        own, dealt = [], [df for df, _ in sides]
    else:
        # One line per cell_rows rows at most, but its size is checked all the same.
        if is_small(parts):
            parts = F.broadcast(parts)
        own, dealt = [f"{n}_part" for _, n in sides], []
        for (df, mine), theirs in zip(sides, reversed(own), strict=True):
            number = salt_of_row(df.drop(mine), 1 << 30)
            mine = f"{mine}_part"
            df = df.withColumn("__dealt", number).join(parts, _CELL, "left")
            every = F.sequence(F.lit(0), F.coalesce(theirs, F.lit(1)) - 1)
            dealt.append(
                df.withColumn(mine, F.col("__dealt") % F.coalesce(mine, F.lit(1)))
                .withColumn(theirs, F.explode(every))
                .drop("__dealt")
            )
    keys = [*_CELL, *own]
    one, other = (df.drop("__list").repartition(tasks, *keys) for df in dealt)
    return one.join(other, keys)


def distance_join(
    points: DataFrame,
    meters: DataFrame,
    metres: float | None = None,
    cell_rows: int = CELL_ROWS,
    decimals: int | None = None,
) -> DataFrame:
    """All pairs of a point and a meter that are within a radius.

    ``points`` has ``lat``, ``lon`` and, unless ``metres`` gives one radius for
    all, a ``metres`` column. ``meters`` has ``latitude`` and ``longitude``.
    The result has the columns of both and ``distance``, rounded to ``decimals``
    after the comparison if that is given.

    The earth is cut into cells. A point looks into the few cells its circle
    touches, at the level that fits its own radius, so one very wide circle
    does not widen the cells of the others. Meters carry one cell per level in
    use. The join is an equi-join on the cell, with the exact distance on top.
    Points of one place and radius travel as lists, and so do meters of one
    position: a distance is worked out once for two lists, and pairs are only
    made after it, in the order of the lists; they are never shuffled.
    A side that measures small is broadcast, after the rows of a crowd were
    spread over the tasks. Otherwise both sides are shuffled. Cells with more
    than ``cell_rows`` points or meters are counted first and dealt into as many
    parts of each as they need; all parts of a cell's points meet all of its meters.
    """
    if metres is not None:
        points = points.withColumn("metres", F.lit(float(metres)))
    radius = F.col("metres")
    points = points.where(
        F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
        & (radius >= 0)
        & ~F.isnan(radius)
    )
    meters = meters.where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    spark = points.sparkSession
    places = gathered(points, _PLACE).withColumnRenamed("__rows", "__points")
    spots = gathered(meters, _SPOT).withColumnRenamed("__rows", "__meters")
    group = {"parquet.block.size": LISTS_GROUP}
    places, spots = stored(places, "places", **group), stored(spots, "spots", **group)
    levels, size, longest = _survey(places)
    placed = _placed(spots, levels)
    if is_small(placed, lists=True):
        # Points in a crowd find far more than others, and may lie side by side.
        if fits_broadcast(spark, size):
            spread = places.repartition(spark.sparkContext.defaultParallelism)
        else:
            spread = places.hint("rebalance")
        pairs = _looking(spread).drop("__list").join(
            F.broadcast(placed.drop("__list")), _CELL
        )
    elif is_small(_looking(places), lists=True):
        looking = F.broadcast(_looking(places).drop("__list"))
        pairs = placed.drop("__list").hint("rebalance").join(looking, _CELL)
    else:
        pairs = _dealt(_looking(places), placed, cell_rows)

    # One point, without a list of its own, is faster in the join's compiled loop.
    several = longest > 1 or "__rows" in points.columns
    distance = F.col("distance")
    shown = distance if decimals is None else F.round(distance, decimals)
    return (
        pairs.withColumn("distance", haversine_m("lat", "lon", "latitude", "longitude"))
        .where(distance <= F.col("metres"))
        .select(*_PLACE, *_SPOT, shown.alias("distance"), "__points", "__meters")
        .select("*", F.inline(_on_demand("__points") if several else "__points"))
        .drop("__points")
        .select("*", F.inline("__meters"))
        .select(*points.columns, *meters.columns, "distance")
    )


def locate(requests: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Add ``lat``/``lon`` of each request's ``address``, NULL where unknown.

    An address listed twice in the gazetteer counts once, with its smallest
    position, so that no request is doubled.
    """
    one_each = (
        gazetteer.where(F.col("address").isNotNull())
        .groupBy("address")
        .agg(F.min(F.struct("lat", "lon")).alias("__at"))
        .select("address", "__at.lat", "__at.lon")
    )
    return lookup_join(requests, one_each, "address", "left")


def unlocated(requests: DataFrame) -> DataFrame:
    """Located requests whose address the gazetteer does not know."""
    return requests.where(F.col("lat").isNull() | F.col("lon").isNull())
