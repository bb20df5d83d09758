"""Row filters: weekday, sessions in progress, hour overlap, possible meters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.timeparse import check_clock, check_hour, weekday_name
from curbside.schemas import CLOSE_HOUR, OPEN_HOUR


def on_weekday(df: DataFrame, day: str) -> DataFrame:
    """Rows of one weekday; prunes partitions on a weekday-partitioned table."""
    return df.where(F.col("Day_Of_Week") == weekday_name(day))


def in_progress_at(sessions: DataFrame, time: str) -> DataFrame:
    """Sessions that began before and end after a clock time, both strictly.

    The clock texts are compared, so a session over midnight never matches.
    """
    time = check_clock(time)
    return sessions.where((F.col("StartTime") < time) & (F.col("EndTime") > time))


def occupied_in_hour(
    sessions: DataFrame,
    hour: int,
    open_hour: int = OPEN_HOUR,
    close_hour: int = CLOSE_HOUR,
) -> DataFrame:
    """Sessions that overlap an hour of operation.

    They start between opening and ``hour`` and end between ``hour`` and the
    last hour. Sessions begun before opening or ending later stay out.
    """
    check_hour(hour, open_hour, close_hour)
    return sessions.where(
        F.col("start_hour").between(open_hour, hour)
        & F.col("end_hour").between(hour, close_hour)
    )


def hours_mask(open_hour: int, close_hour: int) -> Column:
    """Bit set of the hours for which ``occupied_in_hour`` keeps a session.

    NULL for a session that no hour keeps.
    """
    return F.expr(
        f"""CASE WHEN start_hour >= {open_hour} AND end_hour <= {close_hour}
                  AND start_hour <= end_hour
            THEN shiftleft(2, end_hour) - shiftleft(1, start_hour) END"""
    )


def hour_bit(mask: str, hour: int) -> Column:
    """1 if the hour is in the bit set of that column, else 0."""
    return F.expr(f"shiftright({mask}, {hour}) & 1")
