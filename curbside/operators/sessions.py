"""Cleaning of payment logs and meter inventories, and their join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.functions.timeparse import (
    clock,
    event_date,
    parse_session_ts,
    weekday,
    window_15min,
    window_hour,
)
from curbside.operators.joins import lookup_join
from curbside.schemas import DROPPED_SESSION_COLUMNS, METER_COLUMNS

_WINDOWS = {"15min": window_15min, "hour": window_hour}


def meter_base(meters: DataFrame, parity: bool = False) -> DataFrame:
    """Id, cap colour and numeric position of each meter.

    Positions are doubles; ``parity`` gives 32-bit floats, which are about
    0.7 m coarse near longitude -122. Text that is no number becomes NULL.
    """
    kind = "float" if parity else "double"
    post_id, cap_color, longitude, latitude = METER_COLUMNS
    return meters.select(
        post_id,
        cap_color,
        F.col(longitude).try_cast(kind).alias("longitude"),
        F.col(latitude).try_cast(kind).alias("latitude"),
    )


def with_calendar(sessions: DataFrame, window: str = "hour") -> DataFrame:
    """Add date, clock, weekday and window columns to ``start_time``/``end_time``.

    ``window`` chooses the text of ``StartWindow``/``EndWindow``: the quarter
    hour ``HH:mm`` or the hour ``HH``. ``start_hour``/``end_hour`` are numbers.
    """
    if window not in _WINDOWS:
        raise ValueError(f"window must be one of {sorted(_WINDOWS)}, got {window!r}")
    label = _WINDOWS[window]
    timed = sessions.withColumns(
        {
            "EventDate": event_date("start_time"),
            "StartTime": clock("start_time"),
            "EndTime": clock("end_time"),
            "Day_Of_Week": weekday("start_time"),
            "start_hour": F.hour("start_time"),
            "end_hour": F.hour("end_time"),
        }
    )
    return timed.withColumns(
        {
            "StartWindow": label(F.col("StartTime")),
            "EndWindow": label(F.col("EndTime")),
        }
    )


def clean_sessions(raw: DataFrame, window: str = "hour") -> DataFrame:
    """Parsed sessions from the text columns of a payment log.

    Malformed or missing times become NULL and the row stays. Write the result
    (``write_by_weekday``) and filter the table rather than this plan: a filter
    on a derived column would be pushed below it and parse the text again.
    """
    parsed = raw.withColumns(
        {
            "start_time": parse_session_ts("SESSION_START_DT"),
            "end_time": parse_session_ts("SESSION_END_DT"),
        }
    ).drop(*DROPPED_SESSION_COLUMNS)
    return with_calendar(parsed, window)


def publishable(sessions: DataFrame) -> DataFrame:
    """Sessions without the parsed timestamps; their texts remain."""
    return sessions.drop("start_time", "end_time")


def attach_meter(sessions: DataFrame, meters: DataFrame) -> DataFrame:
    """Sessions with the colour and position of their meter.

    An inner join: sessions of unknown or missing meters drop out, and a meter
    listed twice gives each of its sessions twice (see ``duplicate_meters``).
    """
    return lookup_join(sessions, meters, "POST_ID")


def build_sessions(
    raw: DataFrame, meters: DataFrame, window: str = "15min"
) -> DataFrame:
    """The enriched session table from a raw log and a raw meter inventory."""
    return attach_meter(clean_sessions(raw, window), meter_base(meters))


def duplicate_meters(meters: DataFrame) -> DataFrame:
    """Meter ids listed more than once, with their number of rows."""
    counts = meters.groupBy("POST_ID").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)
