"""Answers for one destination: how full is it there, then?

Each answer selects the meters in range first. If they measure small they are
broadcast and the sessions are filtered before anything is shuffled. If not,
the sessions are first aggregated to one row per meter and date, which removes
hot meters, and then joined. Both ways give the same rows.

Averages are over the dates that have any matching session, unless empty days
are asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.scores import (
    occupancy_label,
    possibility,
    ratio_label,
    round_half_even,
    text_or_none,
)
from curbside.functions.timeparse import event_date, weekday
from curbside.operators.aggregates import (
    hour_column,
    meter_count,
    observed_days,
    occupied_days,
)
from curbside.operators.filters import in_progress_at, occupied_in_hour, on_weekday
from curbside.operators.joins import is_small
from curbside.operators.spatial import meters_within
from curbside.schemas import CLOSE_HOUR, MISSING_LABEL, OPEN_HOUR


def calendar_days(sessions: DataFrame, first: str | None, last: str | None) -> DataFrame:
    """``(EventDate, Day_Of_Week)`` of every date from ``first`` to ``last``.

    Without them from the first to the last date of the sessions, of any
    weekday. Dates are generated, so those without a session are there too.
    """
    ends = sessions.agg(
        F.coalesce(F.lit(first), F.min("EventDate")).try_cast("date").alias("first"),
        F.coalesce(F.lit(last), F.max("EventDate")).try_cast("date").alias("last"),
    ).where("first <= last")
    dates = ends.select(F.explode(F.sequence("first", "last")).alias("date"))
    return dates.select(event_date("date").alias("EventDate"), weekday("date").alias("Day_Of_Week"))


def _with_empty_days(per_date: DataFrame, days: DataFrame, day: str) -> DataFrame:
    """Counts of all dates of the weekday among ``days``, 0 where there are none."""
    joined = on_weekday(days, day).join(per_date, "EventDate", "left")
    return joined.select("EventDate", F.coalesce("n", F.lit(0)).alias("n"))


def _average(per_date: DataFrame, near: DataFrame, name: str) -> DataFrame:
    """Average, rounded average, meters in range and label, in one row."""
    return (
        per_date.agg(F.avg("n").alias(name))
        .withColumn("occupied", round_half_even(F.col(name)))
        .withColumn("n_meters", meter_count(near).scalar())
        .withColumn("label", occupancy_label(F.col("occupied"), F.col("n_meters")))
    )


def _copies(near: DataFrame) -> DataFrame:
    """Meter ids in range, with how often the inventory lists each."""
    return near.groupBy("POST_ID").agg(F.count(F.lit(1)).alias("copies"))


def sessions_per_date(hits: DataFrame, near: DataFrame) -> DataFrame:
    """Number of the given sessions per date at the meters in range.

    A meter listed twice in range counts its sessions twice, as it does in the
    joined session table.
    """
    copies = _copies(near)
    if is_small(near):
        joined = hits.join(F.broadcast(copies), "POST_ID")
        n = F.sum("copies")
    else:
        per_meter = hits.groupBy("POST_ID", "EventDate").agg(
            F.count(F.lit(1)).alias("sessions")
        )
        joined = per_meter.join(copies, "POST_ID")
        n = F.sum(F.col("sessions") * F.col("copies"))
    return joined.groupBy("EventDate").agg(n.alias("n"))


def distinct_meters_per_date(hits: DataFrame, near: DataFrame) -> DataFrame:
    """Number of different meters in range per date among the given sessions."""
    ids = near.select("POST_ID").distinct()
    if is_small(near):
        pairs = hits.join(F.broadcast(ids), "POST_ID", "left_semi")
        return pairs.groupBy("EventDate").agg(F.count_distinct("POST_ID").alias("n"))
    pairs = hits.select("POST_ID", "EventDate").distinct()
    pairs = pairs.join(ids, "POST_ID", "left_semi")
    return pairs.groupBy("EventDate").agg(F.count(F.lit(1)).alias("n"))


def avg_sessions_at(
    sessions: DataFrame,
    meters: DataFrame,
    lat: float,
    lon: float,
    metres: float,
    day: str,
    time: str,
    include_empty_days: bool = False,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Average number of sessions in progress at a clock time on a weekday.

    ``include_empty_days`` averages over all dates of the weekday from ``first``
    to ``last``, see ``calendar_days``; a date between them counts as 0 if it has
    no matching session, and dates outside do not count.
    """
    near = meters_within(meters, lat, lon, metres)
    hits = in_progress_at(on_weekday(sessions, day), time)
    per_date = sessions_per_date(hits, near)
    if include_empty_days:
        per_date = _with_empty_days(per_date, calendar_days(sessions, first, last), day)
    return _average(per_date, near, "avg_sessions")


def meters_per_date(
    sessions: DataFrame,
    meters: DataFrame,
    lat: float,
    lon: float,
    metres: float,
    day: str,
    hour: int,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
) -> DataFrame:
    """Number of different meters occupied in the hour, per date."""
    near = meters_within(meters, lat, lon, metres)
    hits = occupied_in_hour(on_weekday(sessions, day), hour, open_hour, close_hour)
    return distinct_meters_per_date(hits, near).withColumnRenamed("n", "n_meters")


def avg_meters_in_hour(
    sessions: DataFrame,
    meters: DataFrame,
    lat: float,
    lon: float,
    metres: float,
    day: str,
    hour: int,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
    include_empty_days: bool = False,
    first: str | None = None,
    last: str | None = None,
) -> DataFrame:
    """Average number of different meters occupied in the hour on a weekday.

    ``include_empty_days``, ``first`` and ``last`` as for ``avg_sessions_at``.
    """
    near = meters_within(meters, lat, lon, metres)
    hits = occupied_in_hour(on_weekday(sessions, day), hour, open_hour, close_hour)
    per_date = distinct_meters_per_date(hits, near)
    if include_empty_days:
        per_date = _with_empty_days(per_date, calendar_days(sessions, first, last), day)
    return _average(per_date, near, "avg_meters")


def attach_days(
    near: DataFrame, days: DataFrame, total_days: Column | int
) -> DataFrame:
    """Every given meter with its occupied days out of ``total_days``.

    A meter without any has NULL days and the missing-value label.
    """
    joined = near.join(days, "POST_ID", "left")
    return label_days(joined, total_days)


def label_days(joined: DataFrame, total_days: Column | int) -> DataFrame:
    """Add ``total_days`` and the label of ``n_days`` out of them."""
    total = total_days if isinstance(total_days, Column) else F.lit(total_days)
    label = F.when(
        F.col("n_days").isNotNull(), ratio_label(F.col("n_days"), F.col("total_days"))
    )
    return joined.withColumn("total_days", total.cast("long")).withColumn(
        "label", F.coalesce(label, F.lit(MISSING_LABEL))
    )


def occupied_days_by_meter(
    sessions: DataFrame,
    meters: DataFrame,
    lat: float,
    lon: float,
    metres: float,
    day: str,
    hour: int,
    total_days: int | None = None,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
) -> DataFrame:
    """Occupied days of every meter in range, out of the observed days.

    ``total_days`` overrides the number of dates seen on that weekday.
    """
    near = meters_within(meters, lat, lon, metres).drop("metres")
    of_day = on_weekday(sessions, day)
    hits = occupied_in_hour(of_day, hour, open_hour, close_hour)
    total = total_days
    if total is None:
        total = observed_days(of_day, by_weekday=False).scalar()
    if not is_small(near):
        return attach_days(near, occupied_days(hits), total)
    # At most one row per meter in range, so the day counts are small as well.
    ids = near.select("POST_ID").distinct()
    days = occupied_days(hits.join(F.broadcast(ids), "POST_ID", "left_semi"))
    return label_days(near.join(F.broadcast(days), "POST_ID", "left"), total)


def meter_possibility(
    pivot: DataFrame,
    meters: DataFrame,
    lat: float,
    lon: float,
    metres: float,
    hour: int,
    n_days: Column | int,
) -> DataFrame:
    """Chance of each meter in range to be occupied in the hour, if any.

    ``n_days`` is the number of days the pivot was counted over, as a number or
    as a scalar subquery such as ``observed_days(s, by_weekday=False).scalar()``.
    """
    near = meters_within(meters, lat, lon, metres).drop("metres")
    counts = hour_column(pivot, hour)
    if is_small(near):
        joined = counts.join(F.broadcast(near), "POST_ID")
    else:
        joined = near.join(counts, "POST_ID")
    return joined.select(
        "POST_ID",
        "latitude",
        "longitude",
        possibility(F.col("n_days"), n_days).alias("possibility"),
    ).where(F.col("possibility") > 0)


def cents(value: Column) -> Column:
    """A two-decimal value as a whole number, whose sum does not depend on order."""
    return F.round(value * 100, 0).cast("long")


def mean_possibility(sum_cents: Column, n: Column) -> Column:
    """Mean of summed two-decimal values, half-even to two decimals."""
    return F.when(n > 0, F.bround(sum_cents / (n * 100), 2))


def area_possibility(
    pivot: DataFrame,
    meters: DataFrame,
    lat: float,
    lon: float,
    metres: float,
    hour: int,
    n_days: Column | int,
) -> DataFrame:
    """Mean possibility over the meters in range that have one."""
    near = meters_within(meters, lat, lon, metres)
    used = meter_possibility(pivot, meters, lat, lon, metres, hour, n_days)
    return (
        used.agg(
            F.sum(cents(F.col("possibility"))).alias("__cents"),
            F.count(F.lit(1)).alias("n_meters_used"),
        )
        .select(
            mean_possibility(F.col("__cents"), F.col("n_meters_used")).alias(
                "possibility"
            ),
            meter_count(near).scalar().alias("n_meters_in_range"),
            "n_meters_used",
        )
        .withColumn("label", text_or_none(F.col("possibility")))
    )
