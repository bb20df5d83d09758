"""The load jobs: read files, clean them, write a table.

A target is the path of a Parquet table, or a pair of connection options and
the name of a relational table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from curbside.operators.aggregates import (
    hour_pivot,
    merge_occupancy,
    occupancy,
    sessions_per_meter_weekday,
)
from curbside.operators.datebits import date_bits, merge_date_bits
from curbside.operators.sessions import (
    attach_meter,
    build_sessions,
    clean_sessions,
    meter_base,
    publishable,
)
from curbside.sources.readers import read_csv_meters, read_csv_sessions
from curbside.sources.writers import write_by_weekday, write_table

Target = str | tuple[Mapping[str, str], str]


def _save(df: DataFrame, target: Target, mode: str) -> None:
    if isinstance(target, str):
        df.write.mode(mode).parquet(target)
    else:
        write_table(df, *target, mode=mode)


def load_sessions(
    spark: SparkSession, log: str, inventory: str, target: Target, mode: str = "append"
) -> None:
    """Enriched sessions with quarter-hour windows."""
    raw, meters = read_csv_sessions(spark, log), read_csv_meters(spark, inventory)
    _save(build_sessions(raw, meters, "15min"), target, mode)


def load_half_file(
    spark: SparkSession, log: str, target: Target, mode: str = "append"
) -> None:
    """Cleaned sessions of a headerless half-file, without their meters."""
    clean = clean_sessions(read_csv_sessions(spark, log, header=False))
    _save(clean, target, mode)


def load_weekday_sessions(
    spark: SparkSession, log: str, inventory: str, path: str
) -> None:
    """Enriched sessions with hour windows, one partition per weekday, in one scan."""
    clean = publishable(clean_sessions(read_csv_sessions(spark, log), "hour"))
    meters = meter_base(read_csv_meters(spark, inventory))
    write_by_weekday(attach_meter(clean, meters), path)


def load_meter_weekday_counts(
    spark: SparkSession, log: str, target: Target, mode: str = "append"
) -> None:
    """Number of sessions per meter and weekday."""
    clean = clean_sessions(read_csv_sessions(spark, log))
    _save(sessions_per_meter_weekday(clean), target, mode)


def load_meters(
    spark: SparkSession, inventory: str, target: Target, mode: str = "append"
) -> None:
    """The meter inventory."""
    _save(meter_base(read_csv_meters(spark, inventory)), target, mode)


def build_hour_pivot(
    spark: SparkSession, sessions: str, target: Target, mode: str = "overwrite"
) -> None:
    """Occupied days per meter and hour, from a written session table."""
    _save(hour_pivot(spark.read.parquet(sessions)), target, mode)


def append_occupancy(sessions: DataFrame, path: str) -> None:
    """Add newly loaded sessions to a stored ``occupancy`` table.

    Only the new sessions are read. Adding the same ones again changes nothing
    that ``read_occupancy`` gives.
    """
    occupancy(sessions).write.mode("append").parquet(path)


def read_occupancy(spark: SparkSession, path: str) -> DataFrame:
    """Hours occupied per meter and date over all that was added.

    ``pivot_of_occupancy`` and ``observed_days`` of it are the hour pivot and
    its number of days; the sessions are not read again for either.
    """
    return merge_occupancy(spark.read.parquet(path))


def append_date_bits(sessions: DataFrame, path: str) -> None:
    """Add newly loaded sessions to a stored table of date bits.

    Only the new sessions are read, and the same ones again change nothing that
    ``read_date_bits`` gives. Rows are sorted by hour and date, so that a query
    for some hour and dates skips row groups.
    """
    bits = date_bits(occupancy(sessions))
    bits.sortWithinPartitions("hour", "block", "POST_ID").write.mode("append").parquet(path)


def read_date_bits(spark: SparkSession, path: str) -> DataFrame:
    """Dates occupied per meter and hour over all that was added."""
    return merge_date_bits(spark.read.parquet(path))
