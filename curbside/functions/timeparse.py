"""Column functions for session timestamps, clock strings and weekdays.

Everything here is a native column expression, so it stays inside whole-stage
code generation. A log carries the time on the wall, so timestamps are parsed
without a zone: the session's time zone and its daylight-saving gaps play no part.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbside.schemas import (
    CLOSE_HOUR,
    OPEN_HOUR,
    SESSION_TS_FORMAT,
    WEEKDAYS,
)

_CLOCK = re.compile(r"([01]\d|2[0-3]):[0-5]\d:[0-5]\d")


# Seconds since this moment make a timestamp that has no zone.
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def parse_session_ts(text: Column | str) -> Column:
    """Zone-free timestamp of a log entry; NULL for NULL or malformed text."""
    text = F.col(text) if isinstance(text, str) else text
    # The text names its zone, UTC, so the session's own is never asked for.
    moment = F.try_to_timestamp(
        F.concat(text, F.lit(" +0000")), F.lit(f"{SESSION_TS_FORMAT} xx")
    )
    seconds = F.make_dt_interval(secs=F.unix_seconds(moment))
    return F.expr(_EPOCH) + seconds


def event_date(ts: Column | str) -> Column:
    """``yyyy-MM-dd`` text of a timestamp."""
    return F.substring(_text(ts), 1, 10)


def clock(ts: Column | str) -> Column:
    """``HH:mm:ss`` text of a timestamp; fixed width, so it sorts as text."""
    return F.substring(_text(ts), 12, 8)


def weekday(ts: Column | str) -> Column:
    """``Mon`` .. ``Sun``, taken from the timestamp without a detour over text."""
    day = F.weekday(F.col(ts) if isinstance(ts, str) else ts)
    return F.get(F.array(*map(F.lit, WEEKDAYS)), day)


def _text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss``, whether or not the timestamp has a zone."""
    return (F.col(ts) if isinstance(ts, str) else ts).cast("string")


def window_15min(clock_text: Column) -> Column:
    """Start of the quarter hour as ``HH:mm``; the empty string for NULL."""
    minute = F.substring(clock_text, 4, 2).try_cast("int")
    quarter = F.lpad((minute - minute % 15).cast("string"), 2, "0")
    return F.coalesce(F.concat(F.substring(clock_text, 1, 3), quarter), F.lit(""))


def window_hour(clock_text: Column) -> Column:
    """Hour part ``HH`` of a clock text; NULL stays NULL."""
    return F.split(clock_text, ":", 2)[0]


def request_hour(time: str) -> int:
    """Hour of a request time such as ``11:00`` (driver side, one request)."""
    hour = time.split(":")[0].strip()
    if not hour.isdigit() or int(hour) > 23:
        raise ValueError(f"not a time of day: {time!r}")
    return int(hour)


def request_hour_column(time: Column | str) -> Column:
    """Hour of each request time in a table; NULL when it is not a number."""
    time = F.col(time) if isinstance(time, str) else time
    return F.trim(F.split(time, ":", 2)[0]).try_cast("int")


def request_clock_column(time: Column | str) -> Column:
    """``HH:mm:ss`` of each request time ``HH:mm`` or ``HH:mm:ss``; else NULL."""
    time = F.trim(F.col(time) if isinstance(time, str) else time)
    whole = F.when(F.length(time) == 5, F.concat(time, F.lit(":00"))).otherwise(time)
    return F.when(F.rlike(whole, F.lit(f"^{_CLOCK.pattern}$")), whole)


def clock_second(clock_text: Column) -> Column:
    """Second of the day of a clock text ``HH:mm:ss``; NULL for other texts."""
    hour, minute, second = (
        F.substring(clock_text, at, 2).try_cast("int") for at in (1, 4, 7)
    )
    return (hour * 60 + minute) * 60 + second


def check_clock(time: str) -> str:
    """A request clock time, which must be ``HH:mm:ss`` to compare as text."""
    if not _CLOCK.fullmatch(time):
        raise ValueError(f"expected HH:mm:ss, got {time!r}")
    return time


def check_hour(hour: int, first: int = OPEN_HOUR, last: int = CLOSE_HOUR) -> int:
    """An hour of operation between ``first`` and ``last``, both inclusive."""
    if not first <= hour <= last:
        raise ValueError(f"hour must be in {first}..{last}, got {hour}")
    return hour


def weekday_name(day: str) -> str:
    """Canonical ``Mon`` .. ``Sun`` for a weekday given in any case."""
    name = day.strip().capitalize()
    if name not in WEEKDAYS:
        raise ValueError(f"not a weekday: {day!r}")
    return name


def weekday_name_column(day: Column | str) -> Column:
    """Canonical weekday of each row; NULL when it is none of the seven."""
    name = F.initcap(F.trim(day))
    return F.when(name.isin(*WEEKDAYS), name)
