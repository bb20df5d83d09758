"""Answers for a whole table of requests in one job.

Nothing is done once per request. Equal destinations are scored once, meters at
one position are counted together, and sessions are reduced to one row per
meter and date before they meet a position. So a popular address, a crowded
position or a busy meter costs no more rows than a quiet one. Positions are
added up to cells first, so a wide circle takes whole cells and costs rows for
its rim alone.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.scores import (
    occupancy_label,
    possibility,
    round_half_even,
    text_or_none,
)
from curbside.functions.timeparse import request_hour_column, weekday_name_column
from curbside.operators.aggregates import (
    observed_days,
    occupied_hours_per_date,
    pivot_hours,
)
from curbside.operators.cover import UNIT, cover
from curbside.operators.filters import hour_bit
from curbside.operators.joins import bytes_of_rows, fits_broadcast, gathered, is_small
from curbside.operators.spatial import distance_join
from curbside.plans.occupancy import cents, label_days, mean_possibility
from curbside.schemas import CLOSE_HOUR, OPEN_HOUR, WEEKDAYS
from curbside.scratch import stored

_PLACE = ["lat", "lon", "metres"]
_SPOT = ["latitude", "longitude"]


def _asked(requests: DataFrame) -> DataFrame:
    """Requests with comparable place, weekday and hour, written once."""
    asked = requests.select(
        "request_id",
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.col("metres").cast("double").alias("metres"),
        F.coalesce(weekday_name_column("day"), F.lit("")).alias("Day_Of_Week"),
        request_hour_column("time").alias("hour"),
    )
    return stored(asked, "requests")


def _placed(meters: DataFrame) -> DataFrame:
    """Meters that have a position, written once."""
    placed = meters.where(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )
    return stored(placed.select("POST_ID", *_SPOT), "placed-meters")


def _spots(placed: DataFrame) -> DataFrame:
    """Meter positions with the number of meters at each."""
    return placed.groupBy(*_SPOT).agg(F.count(F.lit(1)).alias("n"))


def _wanted(sessions: DataFrame, asked: DataFrame) -> DataFrame:
    """Sessions of the weekdays asked for.

    At most seven rows, a proven bound. Naming them lets Spark skip the folders
    of the other weekdays at run time.
    """
    days = asked.select("Day_Of_Week").where(F.col("Day_Of_Week").isin(*WEEKDAYS))
    return sessions.join(F.broadcast(days.distinct()), "Day_Of_Week", "left_semi")


def _positions(placed: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Meters with one position, and all positions of the meters with several.

    A meter that the inventory lists at two positions must count once around a
    place that reaches both, so such meters cannot be added up by position.
    The second table is None if there are none, which is the rule.
    """
    placed = placed.where(F.col("POST_ID").isNotNull())
    at = F.struct(*_SPOT)
    ends = placed.groupBy("POST_ID").agg(
        F.min(at).alias("__first"), F.max(at).alias("__last")
    )
    fixed = F.col("__first") == F.col("__last")
    moved, size = ends.agg(F.count_if(~fixed), bytes_of_rows(ends)).first()
    single = ends.where(fixed).select("POST_ID", "__first.latitude", "__first.longitude")
    if fits_broadcast(placed.sparkSession, size):
        single = F.broadcast(single)
    if not moved:
        return single, None
    several = placed.join(ends.where(~fixed).select("POST_ID"), "POST_ID", "left_semi")
    return single, several.distinct()


def score_requests(
    requests: DataFrame,
    sessions: DataFrame,
    meters: DataFrame,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
) -> DataFrame:
    """Average number of different meters occupied, for every request.

    With the rounded average and the line shown at the destination.
    ``requests`` has ``request_id``, ``lat``, ``lon``, ``metres``, ``day`` and
    ``time``; see ``locate`` for addresses. A request with no position, no such
    weekday or an hour outside operation keeps its row with a NULL average.
    """
    hours = range(open_hour, close_hour + 1)
    counters = [f"n{h}" for h in hours]
    sums = [F.sum(c).alias(c) for c in ("n", *counters)]
    bits = [hour_bit("hours", h).alias(f"n{h}") for h in hours]
    no_meters = F.lit(0).cast("long").alias("n")
    place_day = [*_PLACE, "Day_Of_Week"]
    spot_day = [*_SPOT, "Day_Of_Week"]

    asked, placed = _asked(requests), _placed(meters)
    place_days = asked.select(*place_day).distinct()
    wanted = _wanted(sessions, asked)
    occupied = occupied_hours_per_date(wanted, open_hour, close_hour)

    single, several = _positions(placed)
    spot_dates = (
        occupied.join(single, "POST_ID")
        .select(*spot_day, "EventDate", no_meters, *bits)
        .groupBy(*spot_day, "EventDate")
        .agg(*sums)
    )
    # The meters of a spot ride along as a line without a date, so that one
    # join gives both the meters in range and those occupied.
    spots = _spots(placed)
    any_day = ", ".join(f"'{day}'" for day in (*WEEKDAYS, ""))
    inventory = spots.selectExpr(
        *_SPOT,
        f"explode(array({any_day})) AS Day_Of_Week",
        "CAST(NULL AS STRING) AS EventDate",
        "n",
        *[f"0L AS {c}" for c in counters],
    )
    facts = spot_dates.unionByName(inventory)

    units, members = cover(place_days, spots)
    per_unit = (
        members.join(facts, _SPOT)
        .groupBy(*UNIT, "Day_Of_Week", "EventDate")
        .agg(*sums)
    )
    parts = (
        units.join(place_days, _PLACE)
        .join(per_unit, [*UNIT, "Day_Of_Week"])
        .groupBy(*place_day, "EventDate")
        .agg(*sums)
    )
    if several is not None:
        around = distance_join(place_days, several).drop("distance", *_SPOT).distinct()
        at_several = (
            occupied.join(around, ["POST_ID", "Day_Of_Week"])
            .select(*place_day, "EventDate", no_meters, *bits)
            .groupBy(*place_day, "EventDate")
            .agg(*sums)
        )
        parts = (
            parts.unionByName(at_several)
            .groupBy(*place_day, "EventDate")
            .agg(*sums)
        )

    scored = parts.groupBy(*place_day).agg(
        F.sum("n").alias("n_meters"),
        *[F.expr(f"avg(CASE WHEN {c} > 0 THEN {c} END) AS {c}") for c in counters],
    )
    average = _of_hour("n", hours)
    occupied = round_half_even(average)
    n_meters = F.coalesce(F.col("n_meters"), F.lit(0).cast("long"))
    return _answer(
        asked,
        scored,
        place_day,
        average.alias("avg_meters"),
        occupied.alias("occupied"),
        n_meters.alias("n_meters"),
        occupancy_label(occupied, n_meters).alias("label"),
    )


def score_possibility(
    requests: DataFrame,
    pivot: DataFrame,
    meters: DataFrame,
    n_days: Column | int,
) -> DataFrame:
    """Area possibility for every request, from the hour pivot.

    The weekday plays no part, as the pivot is counted over all of them.
    """
    asked, placed, hours = _asked(requests), _placed(meters), pivot_hours(pivot)
    spots = _spots(placed)
    units, members = cover(asked, spots)

    rated = _rated(pivot, n_days)
    if is_small(placed):
        joined = rated.join(F.broadcast(placed), "POST_ID")
    else:
        joined = placed.join(rated, "POST_ID")
    kept = {h: F.when(F.col(f"p{h}") > 0, F.col(f"p{h}")) for h in hours}
    by_spot = joined.groupBy(*_SPOT).agg(
        *[F.sum(cents(p)).alias(f"c{h}") for h, p in kept.items()],
        *[F.count(p).alias(f"u{h}") for h, p in kept.items()],
    )
    sums = [F.sum(f"{c}{h}").alias(f"{c}{h}") for c in "cu" for h in hours]
    sums.append(F.sum("n").alias("n"))
    facts = spots.join(by_spot, _SPOT, "left")
    per_unit = members.join(facts, _SPOT).groupBy(*UNIT).agg(*sums)
    by_place = units.join(per_unit, UNIT).groupBy(*_PLACE).agg(*sums)
    sum_cents, used = _of_hour("c", hours), _of_hour("u", hours)
    zero = F.lit(0).cast("long")
    mean = mean_possibility(sum_cents, used)
    return _answer(
        asked,
        by_place,
        _PLACE,
        mean.alias("possibility"),
        F.coalesce(F.col("n"), zero).alias("n_meters_in_range"),
        F.coalesce(used, zero).alias("n_meters_used"),
        text_or_none(mean).alias("label"),
    )


def _rated(pivot: DataFrame, n_days: Column | int) -> DataFrame:
    """The possibility of each meter, one column ``p<hour>`` per hour."""
    scores = [
        possibility(F.col(f"h{h}"), n_days).alias(f"p{h}") for h in pivot_hours(pivot)
    ]
    return pivot.select("POST_ID", *scores)


def _in_range(asked: DataFrame, meters: DataFrame) -> DataFrame:
    """Requests that ask the same, as lists in ``__rows``, with each meter in range.

    What is asked and what is known of a meter has to be in the two tables, as
    pairs grow with the product of both and are never shuffled.
    """
    keys = [c for c in asked.columns if c != "request_id"]
    lists = stored(gathered(asked, keys).drop("__list"), "asked-lists")
    return distance_join(lists, meters).drop("distance")


def _each_request(answers: DataFrame, *columns: str) -> DataFrame:
    """Each request of the lists with the answer."""
    return answers.select(F.inline("__rows"), *columns)


def score_meter_days(
    requests: DataFrame,
    sessions: DataFrame,
    meters: DataFrame,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
) -> DataFrame:
    """Occupied days of every meter in range of every request.

    One row per request and meter, as ``occupied_days_by_meter`` gives for one
    request: days occupied in the hour out of the days observed on the weekday,
    and the label. A request with no position, no such weekday or an hour
    outside operation has no rows.

    A meter has its days of all weekdays and hours in one array, of a fixed
    size, in which a request looks up its own.
    """
    hours = range(open_hour, close_hour + 1)
    asked, placed = _asked(requests), _placed(meters)
    wanted = _wanted(sessions, asked)
    answerable = (
        F.col("lat").isNotNull()
        & F.col("lon").isNotNull()
        & F.col("metres").isNotNull()
        & F.col("Day_Of_Week").isin(*WEEKDAYS)
        & F.col("hour").between(open_hour, close_hour)
    )
    of_weekday = F.array(*[F.sum(hour_bit("hours", h)).cast("int") for h in hours])
    days = (
        occupied_hours_per_date(wanted, open_hour, close_hour)
        .groupBy("POST_ID", "Day_Of_Week")
        .agg(of_weekday.alias("days"))
    )
    # At most seven weekdays a meter.
    by_weekday = F.map_from_entries(F.collect_list(F.struct("Day_Of_Week", "days")))
    none = F.array_repeat(F.lit(0), len(hours))
    every = [F.coalesce(F.col("days")[day], none) for day in WEEKDAYS]
    days = (
        days.groupBy("POST_ID")
        .agg(by_weekday.alias("days"))
        .select("POST_ID", F.flatten(F.array(*every)).alias("days"))
    )
    # One line per weekday, at most seven and one for none.
    total = observed_days(wanted).withColumnRenamed("n_days", "observed")
    weekday = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.col("Day_Of_Week"))
    asking = (
        asked.where(answerable)
        .join(F.broadcast(total), "Day_Of_Week", "left")
        .select(
            "request_id",
            *_PLACE,
            ((weekday - 1) * len(hours) + F.col("hour") - open_hour).cast("int").alias("at"),
            F.coalesce("observed", F.lit(0)).alias("observed"),
        )
    )
    placed = stored(placed.join(days, "POST_ID", "left"), "meter-days")
    pairs = _in_range(asking, placed)
    n_days = F.get("days", F.col("at")).cast("long")
    counted = pairs.withColumn("n_days", F.when(n_days > 0, n_days))
    labelled = label_days(counted, F.col("observed"))
    return _each_request(labelled, "POST_ID", *_SPOT, "n_days", "total_days", "label")


def score_meter_possibility(
    requests: DataFrame, pivot: DataFrame, meters: DataFrame, n_days: Column | int
) -> DataFrame:
    """Possibility of every meter in range of every request, if it has one.

    One row per request and meter, as ``meter_possibility`` gives for one request.
    """
    hours = pivot_hours(pivot)
    asked, placed = _asked(requests), _placed(meters)
    answerable = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    answerable &= F.col("metres").isNotNull() & F.col("hour").isin(*hours)
    asking = asked.where(answerable).select("request_id", *_PLACE, "hour")
    rated = stored(placed.join(_rated(pivot, n_days), "POST_ID"), "rated-meters")
    chances = _in_range(asking, rated).withColumn("possibility", _of_hour("p", hours))
    chances = chances.where(F.col("possibility") > 0)
    return _each_request(chances, "POST_ID", *_SPOT, "possibility")


def _of_hour(name: str, hours: Iterable[int]) -> Column:
    """The column ``<name><hour>`` for the hour of each row, else NULL."""
    cases = " ".join(f"WHEN {h} THEN {name}{h}" for h in hours)
    return F.expr(f"CASE hour {cases} END")


def _answer(
    asked: DataFrame, scored: DataFrame, keys: list[str], *columns: Column
) -> DataFrame:
    """Hand each request the answer of its place; unknown places get none."""
    joined = asked.join(scored, keys, "left")
    return joined.select("request_id", *columns)
