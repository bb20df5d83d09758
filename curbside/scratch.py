"""Folders for tables that a job writes and reads back."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors see, removed when the session ends.

    It lies below the folder that ``spark.checkpoint.dir`` names or, where that
    is unset, below the session's warehouse. It does not exist yet. On a cluster
    the setting is required, as a warehouse may be a folder of one machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    own = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only a folder that exists can be marked for removal.
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{own}/{name}-{uuid4().hex}"


def stored(df: DataFrame, name: str, **options: object) -> DataFrame:
    """The rows, written once, so that what reads them twice does not redo them."""
    path = scratch_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
