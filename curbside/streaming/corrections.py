"""Refresh from log files that may arrive again with other rows.

Every row carries the file it comes from and the load that read it. A ledger
says which load of a file counts. Rows are written first and the ledger last, in
one file, so a reader sees the old rows of a file or the new ones, and what a
run that died has written belongs to no load in the ledger.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curbside.operators.sessions import attach_meter, clean_sessions, meter_base
from curbside.sources.readers import read_csv_sessions

_FILE, _LOAD = "source_file", "load_id"
_LEDGER = "source_file string, modified timestamp, size bigint, load_id string, nth bigint"


def _ledger(spark: SparkSession, table: str) -> DataFrame:
    """The load of each file that counts: its latest."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{table}/ledger")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], _LEDGER)
    loads = spark.read.schema(_LEDGER).parquet(f"{table}/ledger")
    latest = loads.groupBy(_FILE).agg(
        F.max_by(F.struct("modified", "size", _LOAD, "nth"), "nth").alias("last")
    )
    return latest.select(_FILE, "last.*")


def _arrived(spark: SparkSession, landing: str, table: str) -> DataFrame:
    """Files that are new, or have another size or time than when they were loaded.

    Only their entries in the folder are looked at.
    """
    present = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(landing)
        .select(
            F.col("_metadata.file_path").alias(_FILE),
            "path",
            F.col("modificationTime").alias("modified"),
            F.col("length").alias("size"),
        )
    )
    known = _ledger(spark, table)
    return present.join(known.select(_FILE, "modified", "size"), [_FILE, "modified", "size"],
                        "left_anti")


def _load(
    spark: SparkSession, files: list, table: str, window: str, meters: DataFrame | None
) -> int:
    load_id, counted = uuid4().hex, Observation()
    log = read_csv_sessions(spark, [f["path"] for f in files])
    rows = clean_sessions(log.withColumn(_FILE, F.col("_metadata.file_path")), window)
    rows = rows.observe(counted, F.count(F.lit(1)).alias("n"))
    if meters is not None:
        rows = attach_meter(rows, meter_base(meters))
    (
        rows.withColumn(_LOAD, F.lit(load_id))
        .write.partitionBy("Day_Of_Week", _LOAD)
        .mode("append")
        .parquet(f"{table}/rows")
    )
    _commit(spark, files, table, load_id)
    return counted.get["n"]


def _commit(spark: SparkSession, files: list, table: str, load_id: str) -> None:
    """One file in the ledger: it is there as a whole or not at all."""
    nth = (_ledger(spark, table).agg(F.max("nth")).first()[0] or 0) + 1
    loads = [(f[_FILE], f["modified"], f["size"], load_id, nth) for f in files]
    entries = spark.createDataFrame(loads, _LEDGER).coalesce(1)
    entries.write.mode("append").parquet(f"{table}/ledger")


def refresh_corrected(
    spark: SparkSession,
    landing: str,
    table: str,
    meters: DataFrame | None = None,
    window: str = "hour",
    files_per_batch: int = 1000,
) -> int:
    """Load the files of ``landing`` that are new or changed; returns the rows read.

    A file that arrives again under its name replaces all rows it had given
    before, whatever weekdays they were on. Each version of a file counts exactly
    once, also when a run dies midway and another one follows. Files that are
    taken away keep their rows. ``files_per_batch`` files are one load, and their
    names are all that the driver holds. See :func:`read_corrected`.

    ``table`` must lie in storage that all executors share and be written by one
    run at a time. A file that changes while it is read is loaded again next time.
    """
    total = 0
    while True:
        arrived = _arrived(spark, landing, table).orderBy(_FILE)
        files = arrived.limit(files_per_batch).collect()
        if not files:
            return total
        total += _load(spark, files, table, window, meters)


def read_corrected(spark: SparkSession, table: str) -> DataFrame:
    """The sessions of the table's files as last loaded, with ``source_file``.

    The ledger has a line for each file, and loads without any are not read.
    """
    counting = _ledger(spark, table).select(_FILE, _LOAD)
    rows = spark.read.parquet(f"{table}/rows")
    return rows.join(counting, [_FILE, _LOAD], "left_semi").drop(_LOAD)


def drop_replaced(spark: SparkSession, table: str, target: str) -> None:
    """Write what counts to a fresh table, without the rows that were replaced."""
    read_corrected(spark, table).withColumn(_LOAD, F.lit("compacted")).write.partitionBy(
        "Day_Of_Week", _LOAD
    ).parquet(f"{target}/rows")
    entries = _ledger(spark, table).withColumn(_LOAD, F.lit("compacted"))
    entries.select(_FILE, "modified", "size", _LOAD, "nth").coalesce(1).write.parquet(
        f"{target}/ledger"
    )
