"""How many sessions are in progress around many places, at many times of day.

A session adds one where it begins and takes one away where it ends. Clocks are
moved to the next one that anybody asks for, so sessions between two such clocks
vanish and all others add up to few rows. Running sums are cut by the hour: what
is in progress when an hour begins is one row, and a clock adds the changes of
its own hour to it. No sum runs over a whole meter or day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbside.functions.scores import occupancy_label, round_half_even
from curbside.functions.timeparse import clock_second, request_clock_column, weekday_name_column
from curbside.operators.cover import PLACE, SPOT, UNIT, cover
from curbside.schemas import WEEKDAYS
from curbside.scratch import stored

_DAY = 24 * 60 * 60
_HOUR = 60 * 60


def _asked(requests: DataFrame) -> DataFrame:
    """Requests with comparable place, weekday and second of the day, written once."""
    asked = requests.select(
        "request_id",
        *[F.col(c).cast("double").alias(c) for c in PLACE],
        F.coalesce(weekday_name_column("day"), F.lit("")).alias("Day_Of_Week"),
        clock_second(request_clock_column("time")).alias("at"),
    )
    return stored(asked, "requests")


def _next_asked(asked: DataFrame) -> DataFrame:
    """For every second of the weekdays asked for, the next second anybody asks.

    At most a week of seconds, whatever the number of requests. Seconds after
    the last one asked have no row.
    """
    wanted = asked.where(F.col("at").isNotNull() & F.col("Day_Of_Week").isin(*WEEKDAYS))
    clocks = wanted.select("Day_Of_Week", "at").distinct()
    before = Window.partitionBy("Day_Of_Week").orderBy("at")
    since = F.coalesce(F.lag("at").over(before) + 1, F.lit(0))
    return clocks.withColumn("since", since).select(
        "Day_Of_Week", F.explode(F.sequence("since", "at")).alias("second"), "at"
    )


def _changes(sessions: DataFrame, asked: DataFrame) -> DataFrame:
    """``(POST_ID, Day_Of_Week, EventDate, at, change)``, changes that are not 0.

    Strictly after its start and strictly before its end a session is in
    progress. One over midnight, whose end is the smaller clock, never is.
    """
    following = stored(_next_asked(asked), "asked-seconds")
    timed = sessions.where("StartTime < EndTime AND POST_ID IS NOT NULL").select(
        "POST_ID",
        "Day_Of_Week",
        "EventDate",
        (clock_second(F.col("StartTime")) + 1).alias("begins"),
        clock_second(F.col("EndTime")).alias("ends"),
    )
    # Seven days of seconds at most, a proven bound.
    begins = F.broadcast(
        following.select("Day_Of_Week", F.col("second").alias("begins"), F.col("at").alias("on"))
    )
    ends = F.broadcast(
        following.select("Day_Of_Week", F.col("second").alias("ends"), F.col("at").alias("off"))
    )
    seen = timed.join(begins, ["Day_Of_Week", "begins"]).join(
        ends, ["Day_Of_Week", "ends"], "left"
    )
    seen = seen.where("off IS NULL OR on < off")
    both = "inline(array(named_struct('at', on, 'change', 1L), named_struct('at', off, 'change', -1L)))"
    keys = ("POST_ID", "Day_Of_Week", "EventDate")
    return (
        seen.selectExpr(*keys, both)
        .where("at IS NOT NULL")
        .groupBy(*keys, "at")
        .agg(F.sum("change").alias("change"))
        .where("change <> 0")
    )


def _by_hour(changes: DataFrame, *keys: str) -> DataFrame:
    """Changes with their hour, and as a change just before each hour what came earlier.

    At most 24 numbers for each of ``keys``, so nothing runs over all changes.
    """
    hour = F.floor(F.col("at") / _HOUR).cast("int")
    within = changes.select(*keys, "at", "change", hour.alias("hour"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("hour") == h, F.col("change"))), F.lit(0)).alias(f"__{h}")
        for h in range(24)
    ]
    nets = F.array(*[f"__{h}" for h in range(24)])
    carried = within.groupBy(*keys).agg(*sums).select(*keys, nets.alias("nets"))
    carried = carried.select(
        *keys, F.explode(F.sequence(F.lit(1), F.lit(23))).alias("hour"), "nets"
    ).select(
        *keys,
        (F.col("hour") * _HOUR - 1).alias("at"),
        F.aggregate(
            F.slice("nets", 1, F.col("hour")), F.lit(0).cast("long"), lambda a, x: a + x
        ).alias("change"),
        "hour",
    )
    return within.unionByName(carried.where("change <> 0"))


def score_in_progress(
    requests: DataFrame, sessions: DataFrame, meters: DataFrame
) -> DataFrame:
    """Average number of sessions in progress, for every request.

    As ``avg_sessions_at`` gives for one: sessions that began before and end
    after the clock, both strictly, of the meters in range, averaged over the
    dates of the weekday that have any. A meter that the inventory lists twice
    in range counts its sessions twice. ``requests`` has ``request_id``, ``lat``,
    ``lon``, ``metres``, ``day`` and ``time``, which is ``HH:mm`` or ``HH:mm:ss``.
    A request with no position, no such weekday or no such time keeps its row
    with a NULL average.
    """
    asked = _asked(requests)
    placed = meters.where(" AND ".join(f"{c} IS NOT NULL" for c in SPOT))
    placed = stored(placed.select("POST_ID", *SPOT), "placed-meters")
    spots = placed.groupBy(*SPOT).agg(F.count(F.lit(1)).alias("n_meters"))
    units, members = cover(asked, spots)

    # Equal meters of a spot are counted, so that each change is joined once a spot.
    listed = placed.where("POST_ID IS NOT NULL").groupBy("POST_ID", *SPOT).count()
    dated = ("Day_Of_Week", "EventDate")
    changes = (
        _changes(sessions, asked)
        .join(listed, "POST_ID")
        .groupBy(*SPOT, *dated, "at")
        .agg(F.sum(F.col("change") * F.col("count")).alias("change"))
    )
    of_units = stored(
        members.join(changes, SPOT)
        .groupBy(*UNIT, *dated, "at")
        .agg(F.sum("change").alias("change"))
        .where("change <> 0"),
        "unit-changes",
    )
    facts = _by_hour(of_units, *UNIT, *dated).select(
        *UNIT, *dated, "hour", F.col("at").alias("until"), "change"
    )
    moments = asked.select(*PLACE, "Day_Of_Week", "at").distinct()
    hour = F.floor(F.col("at") / _HOUR).cast("int")
    per_date = (
        units.join(moments.withColumn("hour", hour), PLACE)
        .join(facts, [*UNIT, "Day_Of_Week", "hour"])
        .where("until <= at")
        .groupBy(*PLACE, "Day_Of_Week", "at", "EventDate")
        .agg(F.sum("change").alias("n"))
        .where("n > 0")
    )
    averages = per_date.groupBy(*PLACE, "Day_Of_Week", "at").agg(F.avg("n").alias("avg_sessions"))
    in_range = (
        units.join(members.join(spots, SPOT), UNIT)
        .groupBy(*PLACE)
        .agg(F.sum("n_meters").alias("n_meters"))
    )
    answered = asked.join(averages, [*PLACE, "Day_Of_Week", "at"], "left").join(
        in_range, PLACE, "left"
    )
    occupied: Column = round_half_even(F.col("avg_sessions"))
    n_meters = F.coalesce(F.col("n_meters"), F.lit(0).cast("long"))
    return answered.select(
        "request_id",
        "avg_sessions",
        occupied.alias("occupied"),
        n_meters.alias("n_meters"),
        occupancy_label(occupied, n_meters).alias("label"),
    )
