"""Native column functions: time parsing, scores and labels, geography."""

from curbside.functions.geo import EARTH_RADIUS_M, geodesic_m, haversine_m
from curbside.functions.scores import (
    occupancy_label,
    possibility,
    ratio_label,
    round_half_even,
    text_or_none,
)
from curbside.functions.timeparse import (
    clock,
    clock_second,
    event_date,
    parse_session_ts,
    request_clock_column,
    request_hour,
    request_hour_column,
    weekday,
    weekday_name,
    weekday_name_column,
    window_15min,
    window_hour,
)

__all__ = [
    "EARTH_RADIUS_M",
    "clock",
    "clock_second",
    "event_date",
    "geodesic_m",
    "haversine_m",
    "occupancy_label",
    "parse_session_ts",
    "possibility",
    "ratio_label",
    "request_clock_column",
    "request_hour",
    "request_hour_column",
    "round_half_even",
    "text_or_none",
    "weekday",
    "weekday_name",
    "weekday_name_column",
    "window_15min",
    "window_hour",
]
