"""The given tables read as parking data.

``events`` plays the payment log, ``customer`` the meters, ``nation`` the
gazetteer and ``supplier`` the requests. Positions are a pattern over the keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.operators.sessions import meter_base, with_calendar
from curbside.schemas import SESSION_TS_FORMAT, WEEKDAYS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _end(ts: Column) -> Column:
    """End of a session whose ``value`` is its length in minutes."""
    seconds = F.floor(F.col("value") * 60).cast("int")
    return F.timestamp_add("SECOND", seconds, ts)


def _log_text(ts: Column) -> Column:
    return F.upper(F.date_format(ts, SESSION_TS_FORMAT))


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment log as text, with ``event_id`` to tell its rows apart."""
    ts = F.col("ts")
    return _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("POST_ID"),
        F.col("props").alias("STREET_BLOCK"),
        F.col("event_type").alias("PAYMENT_TYPE"),
        _log_text(ts).alias("SESSION_START_DT"),
        _log_text(_end(ts)).alias("SESSION_END_DT"),
        F.col("event_type").alias("METER_EVENT_TYPE"),
        F.col("value").cast("string").alias("GROSS_PAID_AMT"),
    )


def typed_sessions(
    spark: SparkSession, sf_dir: str, window: str = "hour"
) -> DataFrame:
    """The cleaned sessions, without the detour over the text of the log.

    Same rows as ``clean_sessions(raw_sessions(...))``. The table has proper
    timestamps already, so queries need not print and parse them.
    """
    second = F.date_trunc("second", F.col("ts").cast("timestamp"))
    end = F.date_trunc("second", _end(F.col("ts")).cast("timestamp"))
    sessions = _table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").cast("string").alias("POST_ID"),
        second.alias("start_time"),
        end.alias("end_time"),
    )
    return with_calendar(sessions, window)


def raw_meters(spark: SparkSession, sf_dir: str, as_text: bool = False) -> DataFrame:
    """The meter inventory; ``as_text`` gives positions as a CSV would."""
    key = F.col("c_custkey")
    latitude = F.lit(37.77) + (key % 37) * F.lit(0.0005)
    longitude = F.lit(-122.42) + (key % 41) * F.lit(0.0005)
    kind = "string" if as_text else "double"
    return _table(spark, sf_dir, "customer").select(
        key.cast("string").alias("POST_ID"),
        F.col("c_mktsegment").alias("CAP_COLOR"),
        longitude.cast(kind).alias("LONGITUDE"),
        latitude.cast(kind).alias("LATITUDE"),
    )


def meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meters with numeric positions."""
    return meter_base(raw_meters(spark, sf_dir))


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with a position each."""
    key = F.col("n_nationkey")
    return _table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("address"),
        (F.lit(37.77) + key * F.lit(0.0007)).alias("lat"),
        (F.lit(-122.42) + key * F.lit(0.0008)).alias("lon"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests: address, radius, weekday and time of day."""
    key = F.col("s_suppkey")
    weekdays = F.array(*[F.lit(day) for day in WEEKDAYS])
    nation = _table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("address")
    )
    return (
        _table(spark, sf_dir, "supplier")
        .join(nation, "s_nationkey")
        .select(
            key.alias("request_id"),
            "address",
            (F.lit(300) + (key % 5) * 100).cast("double").alias("metres"),
            F.get(weekdays, (key % 7).cast("int")).alias("day"),
            F.format_string("%02d:00", F.lit(9) + key % 8).alias("time"),
        )
    )
