"""Distance on the sphere and the cells of the distance join.

Distances are great-circle metres on the mean earth radius; against a spheroid
they differ by up to about 0.5 %, and ``geodesic_m`` gives those. All of it is plain arithmetic in Spark SQL.
The formulas of the cells are texts over the columns ``__level``, ``__row`` and
``__around`` that the join adds step by step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8

# Cells of level k are BASE_CELL_M * 2**k metres high and at least as wide; the
# cells of the top level are wider than half the earth.
BASE_CELL_M = 64.0
TOP_LEVEL = 19

# Boxes are drawn a little too large, so rounding never loses a point that the
# exact distance test would keep.
_SLACK_DEG = 1e-9


def _sql(value: str | float) -> str:
    """A column name as it is, a number as a double literal."""
    return value if isinstance(value, str) else f"{float(value)!r}D"


def haversine_m(
    lat1: str | float, lon1: str | float, lat2: str | float, lon2: str | float
) -> Column:
    """Great-circle distance in metres; each degree is a column name or a number."""
    lat1, lon1, lat2, lon2 = (_sql(v) for v in (lat1, lon1, lat2, lon2))
    return F.expr(
        f"""{_sql(2 * EARTH_RADIUS_M)} * asin(least(1.0D, sqrt(
              pow(sin(radians({lat2} - {lat1}) / 2), 2)
              + cos(radians({lat1})) * cos(radians({lat2}))
                * pow(sin(radians({lon2} - {lon1}) / 2), 2))))"""
    )


# Semi-major axis and flattening of the WGS 84 spheroid.
_AXIS = 6_378_137.0
_FLATTENING = 1 / 298.257223563
_POLAR_AXIS = _AXIS * (1 - _FLATTENING)

# No distance on the spheroid is shorter than that on the sphere by more than this.
SPHERE_MARGIN = 1.006
# Rounds after which a geodesic that is not close to half the earth has settled.
_ROUNDS = 12


def geodesic_m(
    lat1: str | float, lon1: str | float, lat2: str | float, lon2: str | float
) -> Column:
    """Distance in metres on the WGS 84 spheroid; each degree is a column or a number.

    The difference in longitude on the auxiliary sphere is found in a fixed
    number of rounds, one native expression. Right to a millimetre but for
    places that are nearly opposite on the earth.
    """
    lat1, lon1, lat2, lon2 = (_sql(v) for v in (lat1, lon1, lat2, lon2))
    f = _sql(_FLATTENING)
    # Reduced latitudes, as tangents: their sines and cosines follow.
    tan1, tan2 = (f"((1 - {f}) * tan(radians({v})))" for v in (lat1, lat2))
    c1, c2 = (f"(1 / sqrt(1 + {t} * {t}))" for t in (tan1, tan2))
    parts = f"named_struct('c1', {c1}, 's1', {c1} * {tan1}, 'c2', {c2}, 's2', {c2} * {tan2})"
    apart = f"radians({lon2} - {lon1})"
    sine = """sqrt(pow(p.c2 * sin(l), 2)
      + pow(p.c1 * p.s2 - p.s1 * p.c2 * cos(l), 2))"""
    # Each step names what the next ones use.
    arcs = f"named_struct('sin', {sine}, 'cos', p.s1 * p.s2 + p.c1 * p.c2 * cos(l))"
    angles = f"""named_struct('a', atan2(s.sin, s.cos), 'sin', s.sin, 'cos', s.cos, 'turn',
      CASE WHEN s.sin = 0 THEN 0D ELSE p.c1 * p.c2 * sin(l) / s.sin END)"""
    squares = """named_struct('q', 1 - g.turn * g.turn, 'm', CASE WHEN 1 - g.turn * g.turn < 1e-15D
      THEN 0D ELSE g.cos - 2 * p.s1 * p.s2 / (1 - g.turn * g.turn) END)"""

    def let(name: str, value: str, body: str) -> str:
        return f"element_at(transform(array({value}), {name} -> {body}), 1)"

    def with_arcs(body: str) -> str:
        return let("s", arcs, let("g", angles, let("h", squares, body)))

    c = f"({f} / 16 * h.q * (4 + {f} * (4 - 3 * h.q)))"
    again = f"""{apart} + (1 - {c}) * {f} * g.turn * (g.a + {c} * g.sin * (h.m
      + {c} * g.cos * (2 * h.m * h.m - 1)))"""
    settled = f"aggregate(sequence(1, {_ROUNDS}), {apart}, (l, i) -> {with_arcs(again)})"
    ratio = _sql((_AXIS**2 - _POLAR_AXIS**2) / _POLAR_AXIS**2)
    u = f"(h.q * {ratio})"
    big_a = f"(1 + {u} / 16384 * (4096 + {u} * (-768 + {u} * (320 - 175 * {u}))))"
    big_b = f"({u} / 1024 * (256 + {u} * (-128 + {u} * (74 - 47 * {u}))))"
    less = f"""{big_b} * g.sin * (h.m + {big_b} / 4 * (g.cos * (2 * h.m * h.m - 1)
      - {big_b} / 6 * h.m * (4 * g.sin * g.sin - 3) * (4 * h.m * h.m - 3)))"""
    metres = f"{_sql(_POLAR_AXIS)} * {big_a} * (g.a - {less})"
    return F.expr(let("p", parts, let("l", settled, with_arcs(metres))))


def box_around(
    lat: float, lon: float, metres: float, lat_col: Column, lon_col: Column
) -> Column:
    """Bounding box of a circle as literal ranges, which a file scan can use."""
    angle = metres / EARTH_RADIUS_M
    dlat = math.degrees(angle) + _SLACK_DEG
    box = lat_col.between(lat - dlat, lat + dlat)
    if abs(lat) + dlat >= 90:
        return box
    ratio = math.sin(angle) / math.cos(math.radians(lat))
    dlon = math.degrees(math.asin(min(1.0, ratio))) + _SLACK_DEG
    west, east = lon - dlon, lon + dlon
    ranges = lon_col.between(west, east)
    if west < -180:
        ranges = ranges | (lon_col >= west + 360)
    if east > 180:
        ranges = ranges | (lon_col <= east - 360)
    return box & ranges


# Level whose cells are between half the radius and the radius wide. A circle
# then touches three to five cells each way, whose area is at most three times
# its own. Any level would give the right result.
LEVEL = f"""CASE WHEN metres <= {_sql(BASE_CELL_M)} THEN 0
  ELSE CAST(floor(least({_sql(TOP_LEVEL)}, log2(metres / {_sql(BASE_CELL_M)}))) AS INT)
  END"""

_STEP = f"({_sql(math.degrees(BASE_CELL_M / EARTH_RADIUS_M))} * shiftleft(1, __level))"
_LAST_ROW = f"(ceil(180D / {_STEP}) - 1)"
_DLAT = f"(degrees(metres / {_sql(EARTH_RADIUS_M)}) + {_sql(_SLACK_DEG)})"

# Row of cells of a meter, counted from the south pole.
ROW = f"least(floor((latitude + 90) / {_STEP}), {_LAST_ROW})"

# The rows that a circle touches.
ROWS = f"""sequence(
  least(greatest(0L, floor((lat - {_DLAT} + 90) / {_STEP})), {_LAST_ROW}),
  least(greatest(0L, floor((lat + {_DLAT} + 90) / {_STEP})), {_LAST_ROW}))"""

# Number of cells around the earth in a row, so that none is too narrow. A whole
# number of cells per row makes the antimeridian an ordinary border.
AROUND = f"""greatest(1L, floor(360D * cos(radians(least(90D, greatest(
  abs(__row * {_STEP} - 90), abs((__row + 1) * {_STEP} - 90))))) / {_STEP}))"""

# Cell of a meter within its row.
CELL = "pmod(floor((longitude + 180) / 360 * __around), __around)"

_DLON = f"""(CASE WHEN abs(lat) + {_DLAT} >= 90 THEN 180D
  ELSE degrees(asin(least(1D, sin(metres / {_sql(EARTH_RADIUS_M)}) / cos(radians(lat)))))
    + {_sql(_SLACK_DEG)} END)"""
_FIRST = f"floor((lon - {_DLON} + 180) / 360 * __around)"
_LAST = f"floor((lon + {_DLON} + 180) / 360 * __around)"

# The cells that a circle touches within one row, none of them twice.
CELLS = f"""transform(
  sequence({_FIRST}, least({_LAST}, {_FIRST} + __around - 1)),
  c -> pmod(c, __around))"""
