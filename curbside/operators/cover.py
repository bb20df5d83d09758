"""Circles as few pieces: whole cells inside, single positions at the rim.

The earth is cut into a pyramid of cells; one level's cell is four of the next.
A circle is the coarse cells that lie inside it, the finer cells inside it
around those, and the positions within the cells that its rim crosses, of which
each is tested; a crossed cell with many positions is cut into finer ones
first. What is added up over a circle is added up over cells once, for
all circles, so a circle costs rows in proportion to its rim and not to what it
holds.

All of it is arithmetic in Spark SQL over a circle's ``lat``, ``lon`` and
``metres`` and the columns that the steps add.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.functions.geo import EARTH_RADIUS_M, haversine_m
from curbside.scratch import stored

PLACE = ["lat", "lon", "metres"]
SPOT = ["latitude", "longitude"]
# Level, row and cell of a cell; level -1, latitude and longitude of a position.
UNIT = ["__level", "__y", "__x"]

# A position as a unit.
_ITSELF = ["-1 AS __level", "latitude AS __y", "longitude AS __x"]

# Cells of a circle's fine level along its widest extent, half of them at least.
CELLS_ACROSS = 32
# Each coarse cell is so many levels above, that is four by four fine cells.
ABOVE = 2
TOP_LEVEL = 26
# A crossed cell with more positions is cut into cells so many levels below.
CELL_SPOTS = 32
BELOW = 3
# So few positions are all tested at the rim as they are.
FEW_SPOTS = 4096

# Circles are drawn a little larger for cells they touch, and smaller for cells
# they hold; a position on the border is always tested.
_SLACK_DEG = 1e-7
# Circles this close to a pole, or as wide, have no cells inside.
_POLAR_DEG = 85
_WIDE_M = 5_000_000

_ANGLE = f"(metres / {EARTH_RADIUS_M!r}D)"
_DLAT = f"(degrees({_ANGLE}) + {_SLACK_DEG}D)"
_POLAR = f"(abs(lat) + {_DLAT} >= {_POLAR_DEG}D OR metres >= {_WIDE_M}D)"
_DLON = f"""(CASE WHEN {_POLAR} THEN 180D
  ELSE degrees(asin(least(1D, sin({_ANGLE}) / cos(radians(lat))))) + {_SLACK_DEG}D END)"""

_LEVEL = f"""CAST(greatest({ABOVE}D, least({TOP_LEVEL}D,
  floor(log2({180 * CELLS_ACROSS}D / (2 * greatest({_DLAT}, {_DLON})))))) AS INT)"""


def _step(level: str) -> str:
    return f"(180D / shiftleft(1L, {level}))"


def _row(degrees: str, level: str) -> str:
    """Row of cells of a latitude, from the south pole."""
    top = f"(shiftleft(1L, {level}) - 1)"
    return f"least(greatest(0L, floor(({degrees} + 90) / {_step(level)})), {top})"


def _half_width(latitude: str) -> str:
    """Half the circle's extent in degrees of longitude at a latitude, else 0."""
    return f"""(2 * degrees(asin(sqrt(least(1D, greatest(0D,
      (pow(sin({_ANGLE} / 2), 2) - pow(sin(radians({latitude} - lat) / 2), 2))
      / greatest(1e-12D, cos(radians(lat)) * cos(radians({latitude})))))))))"""


def _south(row: str, level: str) -> str:
    return f"({row} * {_step(level)} - 90)"


def _held(row: str, level: str) -> tuple[str, str]:
    """First and last cell of a row that lie inside; none if the last is smaller.

    A row's narrowest extent is at its northern or southern border.
    """
    south, north = _south(row, level), _south(f"({row} + 1)", level)
    width = f"(least({_half_width(south)}, {_half_width(north)}) - {_SLACK_DEG}D)"
    inside = f"""(NOT {_POLAR} AND {width} > 0
      AND {south} >= lat - {_DLAT} AND {north} <= lat + {_DLAT})"""
    first = f"CASE WHEN {inside} THEN ceil((lon - {width} + 180) / {_step(level)}) ELSE 0L END"
    last = f"""CASE WHEN {inside}
      THEN floor((lon + {width} + 180) / {_step(level)}) - 1 ELSE -1L END"""
    return first, last


def _touched(row: str, level: str) -> tuple[str, str]:
    """First and last cell of a row that the circle touches, no cell twice.

    A row's widest extent is at the latitude closest to the circle's widest.
    """
    widest = f"degrees(asin(sin(radians(lat)) / cos({_ANGLE})))"
    south, north = _south(row, level), _south(f"({row} + 1)", level)
    width = f"({_half_width(f'least({north}, greatest({south}, {widest}))')} + {_SLACK_DEG}D)"
    ring = f"shiftleft(1L, {level} + 1)"
    first = f"CASE WHEN {_POLAR} THEN 0L ELSE floor((lon - {width} + 180) / {_step(level)}) END"
    last = f"""CASE WHEN {_POLAR} THEN {ring} - 1
      ELSE floor((lon + {width} + 180) / {_step(level)}) END"""
    return first, last


def _rows(places: DataFrame, above: int) -> DataFrame:
    """Circles, once for each row of cells they touch, ``above`` their fine level."""
    bounds = [_row(f"lat {sign} {_DLAT}", "__level") for sign in "-+"]
    return places.selectExpr(*PLACE, f"{_LEVEL} - {above} AS __level").selectExpr(
        "*", f"explode(sequence({bounds[0]}, {bounds[1]})) AS __row"
    )


def _listed(cells: DataFrame) -> DataFrame:
    """Cells as units; numbers wrap around the earth."""
    return cells.selectExpr(
        *PLACE,
        "__level",
        "CAST(__row AS DOUBLE) AS __y",
        "CAST(pmod(__cell, shiftleft(1L, __level + 1)) AS DOUBLE) AS __x",
    )


def _coarse(places: DataFrame) -> DataFrame:
    """The coarse cells inside each circle."""
    first, last = _held("__row", "__level")
    spans = _rows(places, ABOVE).selectExpr("*", f"{first} AS __first", f"{last} AS __last")
    inside = spans.where("__first <= __last")
    return _listed(inside.selectExpr("*", "explode(sequence(__first, __last)) AS __cell"))


def _fine(places: DataFrame) -> DataFrame:
    """The other fine cells that each circle touches, with ``__inside``."""
    above = f"__level - {ABOVE}"
    spans = {
        "__first": _touched("__row", "__level")[0],
        "__last": _touched("__row", "__level")[1],
        "__in_first": _held("__row", "__level")[0],
        "__in_last": _held("__row", "__level")[1],
        "__up_first": _held(f"shiftright(__row, {ABOVE})", f"({above})")[0],
        "__up_last": _held(f"shiftright(__row, {ABOVE})", f"({above})")[1],
    }
    spanned = _rows(places, 0).selectExpr("*", *[f"{sql} AS {c}" for c, sql in spans.items()])
    last = "least(__last, __first + shiftleft(1L, __level + 1) - 1)"
    cells = spanned.selectExpr("*", f"explode(sequence(__first, {last})) AS __cell")
    cells = cells.where(f"NOT shiftright(__cell, {ABOVE}) BETWEEN __up_first AND __up_last")
    inside = "__cell BETWEEN __in_first AND __in_last AS __inside"
    return cells.selectExpr(*PLACE, "__level", "__row", "__cell", inside)


def _cell_of(spots: DataFrame, levels: list[int]) -> DataFrame:
    """Positions with their cell on each of the levels."""
    listed = ", ".join(map(str, levels))
    ring = "shiftleft(1L, __level + 1)"
    return spots.selectExpr(*SPOT, f"explode(array({listed})) AS __level").selectExpr(
        *SPOT,
        "__level",
        f"CAST({_row('latitude', '__level')} AS DOUBLE) AS __y",
        f"CAST(pmod(floor((longitude + 180) / {_step('__level')}), {ring}) AS DOUBLE) AS __x",
    )


def _cut(crossed: DataFrame) -> DataFrame:
    """Crossed cells as their finer cells, with ``__inside``.

    A cell lies inside if its corners do, as no circle with cells inside is near
    a pole; a border's width is left for rounding.
    """
    side = 1 << BELOW
    finer = crossed.selectExpr(
        *PLACE, f"__level + {BELOW} AS __level", "CAST(__y AS BIGINT) AS __row",
        "CAST(__x AS BIGINT) AS __cell", f"explode(sequence(0, {side * side - 1})) AS __part",
    ).selectExpr(
        *PLACE, "__level", f"__row * {side} + shiftright(__part, {BELOW}) AS __row",
        f"__cell * {side} + (__part & {side - 1}) AS __cell",
    )
    step = _step("__level")
    bordered = finer.selectExpr(
        "*",
        f"{_south('__row', '__level')} AS __south",
        f"{_south('(__row + 1)', '__level')} AS __north",
        f"__cell * {step} - 180 AS __west",
        f"(__cell + 1) * {step} - 180 AS __east",
    )
    farthest = F.greatest(
        *[
            haversine_m("lat", "lon", latitude, longitude)
            for latitude in ("__south", "__north")
            for longitude in ("__west", "__east")
        ]
    )
    across = haversine_m("__south", "__west", "__north", "__east")
    polar, radius = F.expr(_POLAR), F.col("metres")
    measured = bordered.withColumns(
        {
            "__inside": ~polar & (farthest <= radius - 0.01),
            "__outside": ~polar & (farthest - 1.01 * across > radius + 0.01),
        }
    )
    return measured.where("NOT __outside").select(
        *PLACE, "__level", "__row", "__cell", "__inside"
    )


def cover(
    places: DataFrame,
    spots: DataFrame,
    cell_spots: int = CELL_SPOTS,
    few_spots: int = FEW_SPOTS,
) -> tuple[DataFrame, DataFrame]:
    """The units that make up each circle, and the positions of each unit.

    ``places`` has ``lat``, ``lon`` and ``metres``, ``spots`` the different
    ``latitude`` and ``longitude``. The first table has a place and a unit, the
    second a unit and a position, of units that some circle has. A circle holds
    exactly the positions of its units, each in one of them: those within
    ``metres``, border included. Places without a position or with a negative
    radius have no units.
    """
    radius = F.col("metres")
    places = places.select(*PLACE).where(
        F.col("lat").isNotNull() & F.col("lon").isNotNull() & (radius >= 0) & ~F.isnan(radius)
    )
    found = places.agg(F.expr(f"bit_or(shiftleft(1, {_LEVEL}))")).first()[0] or 1 << ABOVE
    levels = [k for k in range(found.bit_length()) if found >> k & 1]
    places = places.distinct()
    spots = spots.select(*SPOT).where(" AND ".join(f"{c} IS NOT NULL" for c in SPOT))

    fine = _fine(places)
    whole = _coarse(places).unionByName(_listed(fine.where("__inside")))
    crossed, tested, used = _listed(fine.where("NOT __inside")), [], set(levels)
    used |= {k - ABOVE for k in levels}
    few = spots.count() <= few_spots
    while True:
        of_cells = _cell_of(spots, levels)
        if few or max(levels) + BELOW > TOP_LEVEL + ABOVE:
            tested.append(crossed.join(of_cells, UNIT))
            break
        counts = of_cells.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("__n"))
        met = stored(crossed.join(counts, UNIT), "crossed")
        quiet = met.where(F.col("__n") <= cell_spots)
        tested.append(quiet.drop("__n").join(of_cells, UNIT))
        loud = met.where(F.col("__n") > cell_spots)
        if loud.isEmpty():
            break
        finer = _cut(loud)
        whole = whole.unionByName(_listed(finer.where("__inside")))
        crossed = _listed(finer.where("NOT __inside"))
        levels = [k + BELOW for k in levels]
        used |= set(levels)
    near = haversine_m("lat", "lon", *SPOT) <= F.col("metres")
    found = [t.where(near).selectExpr(*PLACE, *_ITSELF) for t in tested]
    units = whole
    for some in found:
        units = units.unionByName(some)
    units = stored(units.select(*PLACE, *UNIT), "cover")
    # Only units that a circle has; cells without a position fall out of any join.
    members = (
        _cell_of(spots, sorted(used))
        .unionByName(spots.selectExpr(*SPOT, *_ITSELF))
        .join(units.select(*UNIT), UNIT, "left_semi")
    )
    return units, members
