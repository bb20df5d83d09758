"""Counts per meter, weekday, date and hour.

Distinct days are counted in two steps, first to one row per meter and date and
then per meter. The first step already shrinks on the map side, so a meter with
a third of all sessions reaches the shuffle as at most one row per date and
task.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.functions.timeparse import check_hour
from curbside.operators.filters import hour_bit, hours_mask
from curbside.schemas import CLOSE_HOUR, OPEN_HOUR, PIVOT_HOURS


def sessions_per_meter_weekday(sessions: DataFrame) -> DataFrame:
    """Number of sessions per meter and weekday; NULL keys form groups."""
    return sessions.groupBy("POST_ID", "Day_Of_Week").count()


def active_days_per_meter_weekday(sessions: DataFrame) -> DataFrame:
    """Number of dates with a session per meter and weekday."""
    return sessions.groupBy("POST_ID", "Day_Of_Week").agg(
        F.count_distinct("EventDate").alias("n_days")
    )


def observed_days(sessions: DataFrame, by_weekday: bool = True) -> DataFrame:
    """Number of dates in the data, per weekday or overall."""
    dated = sessions.where(F.col("EventDate").isNotNull())
    keys = ["Day_Of_Week"] if by_weekday else []
    return dated.groupBy(*keys).agg(F.count_distinct("EventDate").alias("n_days"))


def occupied_days(sessions: DataFrame) -> DataFrame:
    """Number of dates per meter among the given sessions."""
    known = sessions.where(F.col("POST_ID").isNotNull())
    return known.groupBy("POST_ID").agg(F.count_distinct("EventDate").alias("n_days"))


def meter_count(meters: DataFrame) -> DataFrame:
    """Number of meters with a position."""
    return meters.agg(F.count("latitude").alias("n_meters"))


def occupied_hours_per_date(
    sessions: DataFrame, open_hour: int = OPEN_HOUR, close_hour: int = CLOSE_HOUR
) -> DataFrame:
    """One row per meter and date with the bit set ``hours`` it was occupied."""
    return (
        sessions.where(F.col("POST_ID").isNotNull())
        .withColumn("__mask", hours_mask(open_hour, close_hour))
        .where(F.col("__mask").isNotNull())
        .groupBy("POST_ID", "Day_Of_Week", "EventDate")
        .agg(F.bit_or("__mask").alias("hours"))
    )


def occupancy(
    sessions: DataFrame, open_hour: int = OPEN_HOUR, close_hour: int = CLOSE_HOUR
) -> DataFrame:
    """One row per meter and date with a session, and the bit set of its hours.

    Unlike ``occupied_hours_per_date`` this has every date seen, with an empty
    bit set where no hour counts, so pivot and observed days both come from it.
    Tables of different arrivals add up, also where they overlap: see
    ``merge_occupancy``.
    """
    mask = F.coalesce(hours_mask(open_hour, close_hour), F.lit(0))
    return (
        sessions.where(F.col("EventDate").isNotNull())
        .withColumn("__mask", mask)
        .groupBy("POST_ID", "Day_Of_Week", "EventDate")
        .agg(F.bit_or("__mask").alias("hours"))
    )


def merge_occupancy(parts: DataFrame) -> DataFrame:
    """The rows of several ``occupancy`` tables as one such table."""
    keys = ("POST_ID", "Day_Of_Week", "EventDate")
    return parts.groupBy(*keys).agg(F.bit_or("hours").alias("hours"))


def pivot_of_occupancy(
    occupied: DataFrame, hours: Iterable[int] = PIVOT_HOURS
) -> DataFrame:
    """The hour pivot from a merged ``occupancy`` table."""
    hours = list(hours)
    counts = [F.sum(hour_bit("hours", h)).alias(f"h{h}") for h in hours]
    known = occupied.where(F.col("POST_ID").isNotNull() & (F.col("hours") != 0))
    pivot = known.groupBy("POST_ID").agg(*counts)
    return pivot.where(" OR ".join(f"h{h} > 0" for h in hours))


def pivot_hours(pivot: DataFrame) -> list[int]:
    """The hours that a pivot has a column for."""
    return sorted(int(c[1:]) for c in pivot.columns if re.fullmatch(r"h\d+", c))


def hour_pivot(
    sessions: DataFrame,
    hours: Iterable[int] = PIVOT_HOURS,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
) -> DataFrame:
    """Occupied days per meter, one column ``h<hour>`` for each hour.

    A column equals ``occupied_days`` over ``occupied_in_hour`` of that hour,
    with 0 for none; a meter never occupied has no row. The hours of a date are
    one bit set, so a long session is not multiplied into one row per hour.
    """
    hours = list(hours)
    for h in hours:
        check_hour(h, open_hour, close_hour)
    per_date = occupied_hours_per_date(sessions, open_hour, close_hour)
    counts = [F.sum(hour_bit("hours", h)).alias(f"h{h}") for h in hours]
    pivot = per_date.groupBy("POST_ID").agg(*counts)
    return pivot.where(" OR ".join(f"h{h} > 0" for h in hours))


def hour_column(pivot: DataFrame, hour: int) -> DataFrame:
    """Meter id and one hour of the pivot as ``n_days``."""
    if hour not in pivot_hours(pivot):
        raise ValueError(f"the pivot has hours {pivot_hours(pivot)}, not {hour}")
    return pivot.select("POST_ID", F.col(f"h{hour}").alias("n_days"))
