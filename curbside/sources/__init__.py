"""Readers, writers and row slicing."""

from curbside.sources.layout import read_within, write_by_place
from curbside.sources.numbering import with_running_index
from curbside.sources.readers import (
    read_csv_meters,
    read_csv_sessions,
    read_table,
    read_weekday,
)
from curbside.sources.slicing import count_prefix, preview, split_at_row, take_prefix
from curbside.sources.writers import write_by_weekday, write_csv, write_table

__all__ = [
    "count_prefix",
    "preview",
    "read_csv_meters",
    "read_csv_sessions",
    "read_table",
    "read_weekday",
    "read_within",
    "split_at_row",
    "take_prefix",
    "with_running_index",
    "write_by_place",
    "write_by_weekday",
    "write_csv",
    "write_table",
]
