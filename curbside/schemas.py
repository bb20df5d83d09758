"""Column names, declared file schemas and the fixed values of the data."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# These must equal what existing files, tables and callers use.
# ---------------------------------------------------------------------------
SESSION_TS_FORMAT = "dd-MMM-yy hh.mm.ss a"
DATE_FORMAT = "yyyy-MM-dd"
CLOCK_FORMAT = "HH:mm:ss"
WEEKDAY_FORMAT = "E"
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")

OPEN_HOUR = 9
CLOSE_HOUR = 17
PIVOT_HOURS = (9, 10, 11, 12, 13, 14, 15, 16)

PREFIX_ROWS = 500
BOUNDED_SCAN_ROWS = 100_000

OCCUPANCY_LABEL = "Historical Occupancy = "
MISSING_LABEL = "None"

SESSION_COLUMNS = (
    "POST_ID",
    "STREET_BLOCK",
    "PAYMENT_TYPE",
    "SESSION_START_DT",
    "SESSION_END_DT",
    "METER_EVENT_TYPE",
    "GROSS_PAID_AMT",
)
UNUSED_LEADING_COLUMN = "NOT_IN_USE"
METER_COLUMNS = ("POST_ID", "CAP_COLOR", "LONGITUDE", "LATITUDE")
# ---------------------------------------------------------------------------

# Session columns without which a payment log cannot be cleaned.
REQUIRED_SESSION_COLUMNS = ("POST_ID", "SESSION_START_DT", "SESSION_END_DT")

# Raw columns that no later step reads.
DROPPED_SESSION_COLUMNS = tuple(
    c for c in (UNUSED_LEADING_COLUMN, *SESSION_COLUMNS) if c != "POST_ID"
)


def _all_strings(names: tuple[str, ...]) -> StructType:
    return StructType([StructField(name, StringType(), True) for name in names])


# The plain log, and the headerless half-file with one extra leading column.
SESSION_SCHEMA = _all_strings(SESSION_COLUMNS)
HALF_FILE_SCHEMA = _all_strings((UNUSED_LEADING_COLUMN, *SESSION_COLUMNS))
