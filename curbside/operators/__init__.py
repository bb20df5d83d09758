"""DataFrame operators: cleaning, filters, joins, aggregates and distance."""

from curbside.operators.addresses import locate_text
from curbside.operators.aggregates import (
    active_days_per_meter_weekday,
    hour_column,
    hour_pivot,
    merge_occupancy,
    meter_count,
    observed_days,
    occupancy,
    occupied_days,
    occupied_hours_per_date,
    pivot_hours,
    pivot_of_occupancy,
    sessions_per_meter_weekday,
)
from curbside.operators.datebits import (
    date_bits,
    merge_date_bits,
    observed_days_between,
    occupied_days_between,
)
from curbside.operators.filters import in_progress_at, occupied_in_hour, on_weekday
from curbside.operators.joins import is_small, lookup_join, salted_join
from curbside.operators.sessions import (
    attach_meter,
    build_sessions,
    clean_sessions,
    duplicate_meters,
    meter_base,
    publishable,
    with_calendar,
)
from curbside.operators.spatial import (
    distance_join,
    locate,
    meters_within,
    unlocated,
    within_distance,
)

__all__ = [
    "active_days_per_meter_weekday",
    "attach_meter",
    "build_sessions",
    "clean_sessions",
    "date_bits",
    "distance_join",
    "duplicate_meters",
    "hour_column",
    "hour_pivot",
    "in_progress_at",
    "is_small",
    "locate",
    "locate_text",
    "lookup_join",
    "merge_date_bits",
    "merge_occupancy",
    "meter_base",
    "meter_count",
    "meters_within",
    "observed_days",
    "observed_days_between",
    "occupancy",
    "occupied_days",
    "occupied_days_between",
    "occupied_hours_per_date",
    "occupied_in_hour",
    "on_weekday",
    "pivot_hours",
    "pivot_of_occupancy",
    "publishable",
    "salted_join",
    "sessions_per_meter_weekday",
    "unlocated",
    "with_calendar",
    "within_distance",
]
