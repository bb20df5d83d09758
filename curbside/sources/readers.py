"""Scans of payment logs, meter inventories and published tables.

A path is any Hadoop URI, a glob, or a list of them. Types are never inferred:
files are read as text and typed by the cleaning step.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from curbside.functions.timeparse import weekday_name
from curbside.schemas import (
    HALF_FILE_SCHEMA,
    METER_COLUMNS,
    REQUIRED_SESSION_COLUMNS,
    SESSION_COLUMNS,
)


def _headered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # enforceSchema off: a file whose header differs from the first one's fails
    # instead of being read into the wrong columns.
    reader = spark.read.option("header", True).option("enforceSchema", False)
    return reader.csv(path)


def read_csv_sessions(
    spark: SparkSession,
    path: str | list[str],
    header: bool = True,
    schema: StructType = HALF_FILE_SCHEMA,
) -> DataFrame:
    """The payment log as text columns.

    With a header the columns are found by name, and only those of the log are
    kept. Without one they are bound by position to ``schema``.
    """
    if not header:
        return spark.read.schema(schema).option("header", False).csv(path)
    log = _headered(spark, path)
    present = {c.lower() for c in log.columns}
    return log.select(
        *[
            c
            for c in SESSION_COLUMNS
            if c in REQUIRED_SESSION_COLUMNS or c.lower() in present
        ]
    )


def read_csv_meters(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Id, cap colour and position texts of the meter inventory."""
    return _headered(spark, path).select(*METER_COLUMNS)


def read_table(
    spark: SparkSession,
    options: Mapping[str, str],
    table: str,
    column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A relational table; filters and projections run at the database.

    ``options`` holds ``url`` and the connection properties. Give ``column``
    with ``lower``, ``upper`` and ``partitions`` to read in parallel; without,
    JDBC has no way to split a table and reads it through one connection.
    """
    properties = {k: v for k, v in options.items() if k != "url"}
    if column is None:
        return spark.read.jdbc(options["url"], table, properties=properties)
    return spark.read.jdbc(
        options["url"],
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties,
    )


def read_weekday(spark: SparkSession, path: str, day: str) -> DataFrame:
    """One weekday of a table written by ``write_by_weekday``; reads no other."""
    table = spark.read.parquet(path)
    return table.where(F.col("Day_Of_Week") == weekday_name(day))
