"""Sinks: relational tables, the weekday-partitioned table and CSV files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.operators.joins import salt_of_row
from curbside.sources.numbering import with_running_index


def write_table(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    mode: str = "append",
    truncate: bool = True,
) -> None:
    """Write to a relational table; an overwrite keeps its definition.

    ``options`` holds ``url``, the connection properties and, if wanted,
    ``numPartitions`` (at most so many connections) and ``batchsize``. A task
    that is run again after its commit repeats its rows, as a database sees no
    Spark task; write Parquet where every row must arrive exactly once.
    """
    properties = {k: v for k, v in options.items() if k != "url"}
    writer = df.write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("truncate", truncate)
    writer.jdbc(options["url"], table, properties=properties)


def write_by_weekday(
    sessions: DataFrame,
    path: str,
    mode: str = "overwrite",
    files_per_weekday: int | None = None,
) -> None:
    """Write all weekdays in one pass, as one partition folder each.

    Adaptive execution cuts the seven weekdays into files of its advisory size
    and so needs no file count; with it off, or with ``files_per_weekday``, the
    rows of a weekday are salted over that many tasks. Rows are sorted by start
    hour within a file, so a scan for one hour can skip row groups. Sessions
    without a weekday go to Hive's default partition and are not lost.
    """
    spark = sessions.sparkSession
    adaptive = spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true"
    if files_per_weekday is None and adaptive:
        laid_out = sessions.hint("rebalance", F.col("Day_Of_Week"))
    else:
        parts = files_per_weekday or int(spark.conf.get("spark.sql.shuffle.partitions"))
        salted = sessions.withColumn("__salt", salt_of_row(sessions, parts))
        laid_out = salted.repartition(7 * parts, "Day_Of_Week", "__salt").drop("__salt")
    (
        laid_out.sortWithinPartitions("Day_Of_Week", "start_hour", "POST_ID")
        .write.partitionBy("Day_Of_Week")
        .mode(mode)
        .parquet(path)
    )


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    mode: str = "error",
    index: str | None = None,
    order_by: str | list[str] | None = None,
) -> None:
    """Write a folder of CSV files, with or without a header line in each.

    ``index`` names a column in front that numbers the rows from 0 in the order
    of ``order_by``, however many there are.
    """
    if index is not None:
        if order_by is None:
            raise ValueError("an index needs order_by")
        df = with_running_index(df, order_by, index)
    df.write.option("header", header).mode(mode).csv(path)
