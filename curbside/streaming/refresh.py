"""Incremental load of newly arrived log files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from curbside.operators.sessions import attach_meter, clean_sessions, meter_base
from curbside.schemas import SESSION_SCHEMA

# Seconds between looks at the progress, and batches that Spark keeps for them.
_LOOK_AFTER = 0.2
_KEPT = "spark.sql.streaming.numRecentProgressUpdates"
_KEPT_BATCHES = 10_000


def refresh_sessions(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    meters: DataFrame | None = None,
    window: str = "hour",
    header: bool = True,
    schema: StructType = SESSION_SCHEMA,
    files_per_batch: int = 1000,
    files_per_weekday: int | None = None,
    archive: str | None = None,
) -> int:
    """Clean the files that are new in ``landing`` and append them to ``table``.

    Runs until all files present have been taken and returns the number of log
    rows read. Each file is loaded exactly once, also when a run dies midway:
    the checkpoint remembers the files, and the table's own log the finished
    batches. With ``meters``, a raw inventory, the sessions carry the position
    of their meter as of this run.

    A batch writes at most ``files_per_weekday`` files for a weekday, by default
    a seventh of the session's shuffle partitions. Each holds some hours of the
    day, so a scan for one hour can skip files.

    Loaded files move to ``archive`` if it is given, so that listing ``landing``
    does not slow down. Their names stay in the checkpoint; a file that comes
    back under a remembered name is not loaded again.

    ``table`` and ``checkpoint`` must lie in storage that all executors share,
    and ``table`` must be written by this function alone.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("header", header)
        .option("enforceSchema", False)
        # A file may arrive with an old date; without this it would be skipped
        # if it were a week older than the newest one.
        .option("maxFileAge", "36500d")
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option(
            "sourceArchiveDir", archive
        )
    sessions = clean_sessions(reader.csv(landing), window)
    if meters is not None:
        sessions = attach_meter(sessions, meter_base(meters))
    parts = files_per_weekday or max(
        1, int(spark.conf.get("spark.sql.shuffle.partitions")) // 7
    )
    query = _start(_laid_out(sessions, parts), table, checkpoint)
    return _rows_read(query)


def _laid_out(sessions: DataFrame, parts: int) -> DataFrame:
    """Rows of a weekday and of a part of its hours in one task."""
    hours = F.floor(F.coalesce("start_hour", F.lit(0)) * parts / 24)
    return sessions.repartition(7 * parts, "Day_Of_Week", hours)


def _start(sessions: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    writer = (
        sessions.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("Day_Of_Week")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    conf = sessions.sparkSession.conf
    before = conf.get(_KEPT)
    conf.set(_KEPT, _KEPT_BATCHES)
    try:
        return writer.start()
    finally:
        conf.set(_KEPT, before)


def _rows_read(query: StreamingQuery) -> int:
    """Rows of all batches, added up while they run; keeps one number.

    If ever more batches end between two looks than Spark keeps, the run goes on
    to its end all the same; only its number of rows is not known then.
    """
    total, last = 0, None
    running = True
    while running:
        running = not query.awaitTermination(_LOOK_AFTER)
        for batch in query.recentProgress:
            number = batch["batchId"]
            if last is not None and number <= last:
                continue
            if last is not None and number > last + 1:
                query.awaitTermination()
                raise RuntimeError("all files are loaded, but their rows were not counted")
            total, last = total + batch["numInputRows"], number
    return total
