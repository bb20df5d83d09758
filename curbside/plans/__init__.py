"""Composite queries for one destination or many requests, and the load jobs."""

from curbside.plans.in_progress import score_in_progress
from curbside.plans.jobs import (
    append_date_bits,
    append_occupancy,
    build_hour_pivot,
    load_half_file,
    load_meter_weekday_counts,
    load_meters,
    load_sessions,
    load_weekday_sessions,
    read_date_bits,
    read_occupancy,
)
from curbside.plans.occupancy import (
    area_possibility,
    attach_days,
    avg_meters_in_hour,
    avg_sessions_at,
    calendar_days,
    distinct_meters_per_date,
    meter_possibility,
    meters_per_date,
    occupied_days_by_meter,
    sessions_per_date,
)
from curbside.plans.scoring import (
    score_meter_days,
    score_meter_possibility,
    score_possibility,
    score_requests,
)

__all__ = [
    "append_date_bits",
    "append_occupancy",
    "area_possibility",
    "attach_days",
    "avg_meters_in_hour",
    "avg_sessions_at",
    "build_hour_pivot",
    "calendar_days",
    "distinct_meters_per_date",
    "load_half_file",
    "load_meter_weekday_counts",
    "load_meters",
    "load_sessions",
    "load_weekday_sessions",
    "meter_possibility",
    "meters_per_date",
    "occupied_days_by_meter",
    "read_date_bits",
    "read_occupancy",
    "score_in_progress",
    "score_meter_days",
    "score_meter_possibility",
    "score_possibility",
    "score_requests",
    "sessions_per_date",
]
