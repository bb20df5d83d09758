"""The operators and queries, each run over the given tables as a whole.

Output columns are lower case. Distances are rounded to three decimals and
averages to six, as the last bit of a double may differ between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside import fixtures as given
from curbside.functions import parse_session_ts
from curbside.operators import (
    active_days_per_meter_weekday,
    attach_meter,
    build_sessions,
    clean_sessions,
    distance_join,
    duplicate_meters,
    hour_column,
    hour_pivot,
    in_progress_at,
    locate,
    locate_text,
    meter_base,
    meter_count,
    meters_within,
    observed_days,
    observed_days_between,
    occupied_days,
    occupied_days_between,
    occupied_in_hour,
    on_weekday,
    pivot_of_occupancy,
    publishable,
    sessions_per_meter_weekday,
    unlocated,
    within_distance,
)
from curbside.plans import (
    append_date_bits,
    append_occupancy,
    area_possibility,
    avg_meters_in_hour,
    avg_sessions_at,
    build_hour_pivot,
    load_half_file,
    load_meter_weekday_counts,
    load_meters,
    load_sessions,
    load_weekday_sessions,
    meter_possibility,
    meters_per_date,
    occupied_days_by_meter,
    read_date_bits,
    read_occupancy,
    score_in_progress,
    score_meter_days,
    score_meter_possibility,
    score_possibility,
    score_requests,
    sessions_per_date,
)
from curbside.schemas import SESSION_COLUMNS, UNUSED_LEADING_COLUMN
from curbside.scratch import scratch_folder
from curbside.sources import (
    count_prefix,
    preview,
    read_csv_sessions,
    read_weekday,
    read_within,
    split_at_row,
    take_prefix,
    write_by_place,
    write_by_weekday,
    write_csv,
)
from curbside.streaming import read_corrected, refresh_corrected, refresh_sessions

Query = Callable[[SparkSession, str], DataFrame]

PLACE = (37.779, -122.41, 600.0)
DAY = "Mon"
TIME = "11:00:00"
HOUR = 11


def _average(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.round(name, 6))


def parse_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sessions(given.raw_sessions(spark, sf_dir)).select(
        "event_id",
        F.col("POST_ID").alias("post_id"),
        F.col("EventDate").alias("event_date"),
        F.col("StartTime").alias("start_time"),
        F.col("EndTime").alias("end_time"),
        F.col("Day_Of_Week").alias("day_of_week"),
    )


def windows_15min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sessions(given.raw_sessions(spark, sf_dir), "15min").select(
        "event_id",
        F.col("StartWindow").alias("start_window"),
        F.col("EndWindow").alias("end_window"),
    )


def windows_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_sessions(given.raw_sessions(spark, sf_dir), "hour").select(
        "event_id",
        "start_hour",
        "end_hour",
        F.col("StartWindow").alias("start_window"),
        F.col("EndWindow").alias("end_window"),
    )


def all_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = meter_base(given.raw_meters(spark, sf_dir, as_text=True))
    return base.select(
        F.col("POST_ID").alias("post_id"),
        F.col("CAP_COLOR").alias("cap_color"),
        "longitude",
        "latitude",
    )


def _enriched(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        *[c for c in sessions.columns if c == "event_id"],
        F.col("POST_ID").alias("post_id"),
        F.col("EventDate").alias("event_date"),
        F.col("StartTime").alias("start_time"),
        F.col("EndTime").alias("end_time"),
        F.col("Day_Of_Week").alias("day_of_week"),
        F.col("StartWindow").alias("start_window"),
        F.col("EndWindow").alias("end_window"),
        F.col("CAP_COLOR").alias("cap_color"),
        "longitude",
        "latitude",
    )


def enriched_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(
        build_sessions(
            given.raw_sessions(spark, sf_dir), given.raw_meters(spark, sf_dir)
        )
    )


def published_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions = publishable(clean_sessions(given.raw_sessions(spark, sf_dir), "hour"))
    return _enriched(attach_meter(sessions, given.meters(spark, sf_dir)))


def weekday_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "sessions")
    write_by_weekday(given.typed_sessions(spark, sf_dir), path)
    return read_weekday(spark, path, DAY).select(
        "event_id", F.col("POST_ID").alias("post_id")
    )


def meter_weekday_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = sessions_per_meter_weekday(given.typed_sessions(spark, sf_dir))
    return counts.select(
        F.col("POST_ID").alias("post_id"),
        F.col("Day_Of_Week").alias("day_of_week"),
        F.col("count").alias("n_sessions"),
    )


def meter_weekday_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = active_days_per_meter_weekday(given.typed_sessions(spark, sf_dir))
    return counts.select(
        F.col("POST_ID").alias("post_id"),
        F.col("Day_Of_Week").alias("day_of_week"),
        "n_days",
    )


def weekday_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = observed_days(given.typed_sessions(spark, sf_dir))
    return days.select(F.col("Day_Of_Week").alias("day_of_week"), "n_days")


def near_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meters_within(given.meters(spark, sf_dir), *PLACE).select(
        F.col("POST_ID").alias("post_id"), F.round("metres", 3).alias("metres")
    )


def near_meters_on_spheroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = meters_within(given.meters(spark, sf_dir), *PLACE, spheroid=True)
    return near.select(F.col("POST_ID").alias("post_id"), F.round("metres", 3).alias("metres"))


def near_meter_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meter_count(within_distance(given.meters(spark, sf_dir), *PLACE))


def _hits(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        "event_id",
        F.col("POST_ID").alias("post_id"),
        F.col("EventDate").alias("event_date"),
    )


def sessions_in_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(in_progress_at(given.typed_sessions(spark, sf_dir), TIME))


def sessions_in_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(occupied_in_hour(given.typed_sessions(spark, sf_dir), HOUR))


def _place_data(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return given.typed_sessions(spark, sf_dir), given.meters(spark, sf_dir)


def sessions_of_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hits(on_weekday(given.typed_sessions(spark, sf_dir), DAY))


def meter_days_in_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = occupied_in_hour(given.typed_sessions(spark, sf_dir), HOUR)
    return occupied_days(hits).withColumnRenamed("POST_ID", "post_id")


def place_sessions_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions, meters = _place_data(spark, sf_dir)
    hits = in_progress_at(on_weekday(sessions, DAY), TIME)
    per_date = sessions_per_date(hits, meters_within(meters, *PLACE))
    return per_date.select(
        F.col("EventDate").alias("event_date"), F.col("n").alias("n_sessions")
    )


def place_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    return _average(avg_sessions_at(*data, *PLACE, DAY, TIME), "avg_sessions")


def place_meters_per_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    per_date = meters_per_date(*data, *PLACE, DAY, HOUR)
    return per_date.select(F.col("EventDate").alias("event_date"), "n_meters")


def place_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    return _average(avg_meters_in_hour(*data, *PLACE, DAY, HOUR), "avg_meters")


def place_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    return occupied_days_by_meter(*data, *PLACE, DAY, HOUR).withColumnRenamed(
        "POST_ID", "post_id"
    )


def pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = hour_pivot(given.typed_sessions(spark, sf_dir))
    return table.withColumnRenamed("POST_ID", "post_id")


def pivot_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = hour_pivot(given.typed_sessions(spark, sf_dir))
    return hour_column(table, HOUR).withColumnRenamed("POST_ID", "post_id")


def _pivot_data(spark: SparkSession, sf_dir: str):
    """Pivot and number of days from one stored table: sessions are read once."""
    sessions, meters = _place_data(spark, sf_dir)
    path = scratch_folder(spark, "occupancy")
    append_occupancy(sessions, path)
    occupied = read_occupancy(spark, path)
    n_days = observed_days(occupied, by_weekday=False).scalar()
    return pivot_of_occupancy(occupied), meters, n_days


def pivot_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that arrive in two overlapping parts, and the pivot after that."""
    sessions = given.typed_sessions(spark, sf_dir)
    path = scratch_folder(spark, "occupancy")
    for part in (F.col("event_id") % 3 < 2, F.col("event_id") % 3 > 0):
        append_occupancy(sessions.where(part), path)
    pivot_table = pivot_of_occupancy(read_occupancy(spark, path))
    return pivot_table.withColumnRenamed("POST_ID", "post_id")


def place_possibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, meters, n_days = _pivot_data(spark, sf_dir)
    chances = meter_possibility(table, meters, *PLACE, HOUR, n_days)
    return chances.withColumnRenamed("POST_ID", "post_id")


def place_area_possibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, meters, n_days = _pivot_data(spark, sf_dir)
    return area_possibility(table, meters, *PLACE, HOUR, n_days)


def _located(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate(given.requests(spark, sf_dir), given.gazetteer(spark, sf_dir))


def located_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _located(spark, sf_dir).select("request_id", "lat", "lon")


def request_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _located(spark, sf_dir).select("request_id", "lat", "lon", "metres")
    meters = given.meters(spark, sf_dir).select("POST_ID", "latitude", "longitude")
    pairs = distance_join(asked, meters, decimals=3)
    return pairs.select(
        "request_id", F.col("POST_ID").alias("post_id"), F.col("distance").alias("metres")
    )


def scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    return _average(score_requests(_located(spark, sf_dir), *data), "avg_meters")


def possibility_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_possibility(_located(spark, sf_dir), *_pivot_data(spark, sf_dir))


def in_progress_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The requests, each at its own second of the day."""
    key = F.col("request_id")
    time = F.format_string("%02d:%02d:%02d", 9 + key % 8, key * 7 % 60, key * 13 % 60)
    requests = _located(spark, sf_dir).withColumn("time", time)
    return _average(score_in_progress(requests, *_place_data(spark, sf_dir)), "avg_sessions")


def request_meter_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    days = score_meter_days(_located(spark, sf_dir), *data)
    return days.withColumnRenamed("POST_ID", "post_id")


def request_meter_possibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    chances = score_meter_possibility(
        _located(spark, sf_dir), *_pivot_data(spark, sf_dir)
    )
    return chances.withColumnRenamed("POST_ID", "post_id")


def unknown_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for addresses that a gazetteer of every other nation lacks."""
    known = given.gazetteer(spark, sf_dir).where(F.length("address") % 2 == 0)
    requests = given.requests(spark, sf_dir)
    return unlocated(locate(requests, known)).select("request_id", "address")


def doubled_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory that lists every seventh meter three times."""
    once = given.meters(spark, sf_dir)
    again = once.where(F.col("POST_ID").cast("long") % 7 == 0)
    inventory = once.unionByName(again).unionByName(again)
    return duplicate_meters(inventory).withColumnRenamed("POST_ID", "post_id")


def previewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any twenty rows; their number and that all are rows of the log."""
    raw = given.raw_sessions(spark, sf_dir)
    shown = preview(raw, 20).join(raw.select("event_id"), "event_id", "left_semi")
    return shown.agg(F.count(F.lit(1)).alias("n_rows"))


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = given.raw_sessions(spark, sf_dir).select(*SESSION_COLUMNS)
    plain = scratch_folder(spark, "log")
    half = scratch_folder(spark, "half-log")
    write_csv(log, plain)
    unused = F.lit("").alias(UNUSED_LEADING_COLUMN)
    write_csv(log.select(unused, *SESSION_COLUMNS), half, header=False)
    forms = {
        "header": read_csv_sessions(spark, plain),
        "headerless": read_csv_sessions(spark, half, header=False),
    }
    columns = [F.col(c).alias(c.lower()) for c in SESSION_COLUMNS]
    one, other = [df.select(F.lit(f).alias("form"), *columns) for f, df in forms.items()]
    return one.unionByName(other)


def _files(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """The log and the inventory as CSV files."""
    log, inventory = scratch_folder(spark, "log"), scratch_folder(spark, "meters")
    write_csv(given.raw_sessions(spark, sf_dir).select(*SESSION_COLUMNS), log)
    write_csv(given.raw_meters(spark, sf_dir, as_text=True), inventory)
    return log, inventory


def indexed_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log as CSV with a running number in front, read back."""
    raw = given.raw_sessions(spark, sf_dir)
    path = scratch_folder(spark, "indexed")
    write_csv(raw, path, index="row_index", order_by=["POST_ID", "event_id"])
    back = spark.read.option("header", True).csv(path)
    return back.select(
        *[F.col(c).cast("long").alias(c) for c in ("row_index", "event_id")],
        F.col("POST_ID").alias("post_id"),
        F.col("SESSION_START_DT").alias("session_start_dt"),
    )


def stored_meters_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "meters-by-place")
    write_by_place(given.meters(spark, sf_dir), path)
    near = read_within(spark, path, *PLACE)
    return near.select(F.col("POST_ID").alias("post_id"), "latitude", "longitude")


def stored_sessions_within(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of one weekday near a place, from a table by weekday and place."""
    path = scratch_folder(spark, "sessions-by-place")
    write_by_place(attach_meter(*_place_data(spark, sf_dir)), path, by_weekday=True)
    return _hits(on_weekday(read_within(spark, path, *PLACE), DAY))


def place_sessions_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    average = avg_sessions_at(
        *data, *PLACE, DAY, "04:00:00", include_empty_days=True, last="2024-03-31"
    )
    return _average(average, "avg_sessions")


def place_meters_all_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = _place_data(spark, sf_dir)
    average = avg_meters_in_hour(*data, *PLACE, DAY, HOUR, include_empty_days=True,
                                 first="2023-12-01", last="2024-03-31")
    return _average(average, "avg_meters")


def _misspelt(requests: DataFrame) -> DataFrame:
    """Addresses as typed in a hurry: signs, a letter left out, a wrong one, two swapped."""
    a, key = F.col("address"), F.col("request_id") % 5
    typed = (
        F.when(key == 0, F.concat(F.lit(" "), F.lower(a), F.lit("!")))
        .when(key == 1, F.concat(F.substring(a, 1, 2), F.expr("substring(address, 4)")))
        .when(key == 2, F.concat(F.lit("X"), F.expr("substring(address, 2)")))
        .when(key == 3, F.concat(F.expr("substring(address, 2, 1)"), F.substring(a, 1, 1),
                                 F.expr("substring(address, 3)")))
        .otherwise(F.concat(a, F.lit("q")))
    )
    return requests.withColumn("address", typed)


RANGE = ("2024-01-05", "2024-01-23")


def _date_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bits of sessions that arrive in two overlapping parts."""
    sessions, path = given.typed_sessions(spark, sf_dir), scratch_folder(spark, "date-bits")
    for part in (F.col("event_id") % 3 < 2, F.col("event_id") % 3 > 0):
        append_date_bits(sessions.where(part), path)
    return read_date_bits(spark, path)


def meter_days_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = occupied_days_between(_date_bits(spark, sf_dir), HOUR, *RANGE)
    return days.withColumnRenamed("POST_ID", "post_id")


def weekdays_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observed_days_between(_date_bits(spark, sf_dir), *RANGE, DAY)


def typed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _misspelt(given.requests(spark, sf_dir))
    return locate_text(asked, given.gazetteer(spark, sf_dir)).select(
        "request_id", "address", "found_address", "edits", "lat", "lon"
    )


def loaded_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_folder(spark, "sessions")
    load_sessions(spark, *_files(spark, sf_dir), table)
    return _enriched(spark.read.parquet(table))


def loaded_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_folder(spark, "sessions")
    load_weekday_sessions(spark, *_files(spark, sf_dir), table)
    return _enriched(read_weekday(spark, table, DAY))


def loaded_half_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, table = scratch_folder(spark, "half-log"), scratch_folder(spark, "sessions")
    raw = given.raw_sessions(spark, sf_dir).select(*SESSION_COLUMNS)
    unused = F.lit("").alias(UNUSED_LEADING_COLUMN)
    write_csv(raw.select(unused, "*"), log, header=False)
    load_half_file(spark, log, table)
    return spark.read.parquet(table).select(
        F.col("POST_ID").alias("post_id"),
        F.col("EventDate").alias("event_date"),
        F.col("StartTime").alias("start_time"),
        F.col("EndTime").alias("end_time"),
        F.col("Day_Of_Week").alias("day_of_week"),
        "start_hour",
        "end_hour",
    )


def loaded_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_folder(spark, "counts")
    load_meter_weekday_counts(spark, _files(spark, sf_dir)[0], table)
    return spark.read.parquet(table).select(
        F.col("POST_ID").alias("post_id"),
        F.col("Day_Of_Week").alias("day_of_week"),
        F.col("count").alias("n_sessions"),
    )


def loaded_meters(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = scratch_folder(spark, "meters")
    load_meters(spark, _files(spark, sf_dir)[1], table)
    return spark.read.parquet(table).select(
        F.col("POST_ID").alias("post_id"),
        F.col("CAP_COLOR").alias("cap_color"),
        "longitude",
        "latitude",
    )


def built_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    sessions, table = scratch_folder(spark, "sessions"), scratch_folder(spark, "pivot")
    write_by_weekday(given.typed_sessions(spark, sf_dir), sessions)
    build_hour_pivot(spark, sessions, table)
    return spark.read.parquet(table).withColumnRenamed("POST_ID", "post_id")


def prefix_500(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given.raw_sessions(spark, sf_dir)
    first = take_prefix(raw, 500, "event_id", index="row_index")
    return first.select(
        "row_index",
        "event_id",
        F.col("POST_ID").alias("post_id"),
        F.col("SESSION_START_DT").alias("session_start_dt"),
    )


def bounded_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_prefix(given.raw_sessions(spark, sf_dir))


def small_bounded_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_prefix(given.raw_sessions(spark, sf_dir), 700)


def split_at_tie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log cut at a third of its rows in the order of a column with few values."""
    raw = given.raw_sessions(spark, sf_dir)
    total = raw.count()
    first, second = split_at_row(raw, total // 3, "PAYMENT_TYPE", total)
    parts = [first.select(F.lit(1).alias("part"), "event_id", "PAYMENT_TYPE")]
    parts += [second.select(F.lit(2).alias("part"), "event_id", "PAYMENT_TYPE")]
    both = parts[0].unionByName(parts[1])
    return both.withColumnRenamed("PAYMENT_TYPE", "payment_type")


def split_in_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = given.raw_sessions(spark, sf_dir)
    total = raw.count()
    parts = split_at_row(raw, total // 2, "event_id", total)
    totals = [
        part.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("event_id").alias("min_event_id"),
            F.max("event_id").alias("max_event_id"),
        ).select(F.lit(i).alias("part"), "*")
        for i, part in enumerate(parts, start=1)
    ]
    return totals[0].unionByName(totals[1])


def refreshed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of files, each followed by two runs; the second adds nothing."""
    log = given.raw_sessions(spark, sf_dir).select(*SESSION_COLUMNS)
    day = F.dayofmonth(parse_session_ts("SESSION_START_DT"))
    first_half = F.coalesce(day <= 15, F.lit(False))
    landing = scratch_folder(spark, "landing")
    table = scratch_folder(spark, "refreshed")
    checkpoint = scratch_folder(spark, "refresh-checkpoint")
    for arrived in (first_half, ~first_half):
        write_csv(log.where(arrived), landing, mode="append")
        for _ in range(2):
            refresh_sessions(spark, landing, table, checkpoint)
    return spark.read.parquet(table).select(
        F.col("POST_ID").alias("post_id"),
        F.col("EventDate").alias("event_date"),
        F.col("StartTime").alias("start_time"),
        F.col("EndTime").alias("end_time"),
        F.col("Day_Of_Week").alias("day_of_week"),
        "start_hour",
        "end_hour",
    )


def corrected_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four log files, of which one arrives again with other meters and fewer rows."""
    log = given.raw_sessions(spark, sf_dir)
    landing, table = scratch_folder(spark, "landing"), scratch_folder(spark, "corrected")
    for part in range(4):
        one = log.where(F.col("event_id") % 4 == part).select(*SESSION_COLUMNS)
        _arrive(spark, one, f"{landing}/week{part}.csv")
    refresh_corrected(spark, landing, table)
    again = log.where((F.col("event_id") % 4 == 2) & (F.col("event_id") % 3 == 0))
    moved = again.withColumn("POST_ID", F.concat(F.lit("moved "), "POST_ID"))
    _arrive(spark, moved.select(*SESSION_COLUMNS), f"{landing}/week2.csv")
    for _ in range(2):
        refresh_corrected(spark, landing, table)
    return read_corrected(spark, table).select(
        F.col("POST_ID").alias("post_id"),
        F.col("EventDate").alias("event_date"),
        F.col("StartTime").alias("start_time"),
        F.col("EndTime").alias("end_time"),
        F.col("Day_Of_Week").alias("day_of_week"),
    )


def _arrive(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Put the rows under a file's name, in place of what it was before."""
    folder = scratch_folder(spark, "arriving")
    write_csv(rows.coalesce(1), folder)
    names = spark._jvm.org.apache.hadoop.fs
    target, source = names.Path(path), names.Path(folder)
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    written = [f.getPath() for f in files.listStatus(source)]
    (part,) = [p for p in written if p.getName().startswith("part-")]
    files.mkdirs(target.getParent())
    files.delete(target, False)
    files.rename(part, target)


QUERIES: dict[str, Query] = {
    "parse_sessions": parse_sessions,
    "windows_15min": windows_15min,
    "windows_hour": windows_hour,
    "meter_base": all_meters,
    "enriched_sessions": enriched_sessions,
    "published_sessions": published_sessions,
    "weekday_partition": weekday_partition,
    "sessions_per_meter_weekday": meter_weekday_sessions,
    "active_days_per_meter_weekday": meter_weekday_days,
    "observed_days": weekday_days,
    "meters_within": near_meters,
    "meters_within_spheroid": near_meters_on_spheroid,
    "meter_count_within": near_meter_count,
    "on_weekday": sessions_of_weekday,
    "in_progress_at": sessions_in_progress,
    "occupied_in_hour": sessions_in_hour,
    "sessions_per_date": place_sessions_per_date,
    "avg_sessions_at": place_sessions,
    "meters_per_date": place_meters_per_date,
    "avg_meters_in_hour": place_meters,
    "occupied_days": meter_days_in_hour,
    "occupied_days_by_meter": place_days,
    "hour_pivot": pivot,
    "hour_column": pivot_hour,
    "meter_possibility": place_possibility,
    "area_possibility": place_area_possibility,
    "locate_requests": located_requests,
    "distance_join": request_meters,
    "score_requests": scored_requests,
    "score_possibility": possibility_requests,
    "csv_roundtrip": csv_roundtrip,
    "load_sessions": loaded_sessions,
    "load_weekday_sessions": loaded_weekday,
    "prefix_500": prefix_500,
    "count_prefix": bounded_count,
    "split_at_row": split_in_halves,
    "refresh_sessions": refreshed_sessions,
    "hour_pivot_upkeep": pivot_upkeep,
    "score_in_progress": in_progress_requests,
    "score_meter_days": request_meter_days,
    "score_meter_possibility": request_meter_possibility,
    "unlocated_requests": unknown_requests,
    "duplicate_meters": doubled_meters,
    "preview": previewed,
    "load_half_file": loaded_half_file,
    "load_meter_weekday_counts": loaded_counts,
    "load_meters": loaded_meters,
    "build_hour_pivot": built_pivot,
    "count_prefix_bounded": small_bounded_count,
    "split_at_tied_row": split_at_tie,
    "indexed_csv": indexed_csv,
    "stored_meters_within": stored_meters_within,
    "stored_sessions_within": stored_sessions_within,
    "avg_sessions_all_days": place_sessions_all_days,
    "avg_meters_all_days": place_meters_all_days,
    "refresh_corrected": corrected_sessions,
    "locate_text": typed_requests,
    "occupied_days_between": meter_days_between,
    "observed_days_between": weekdays_between,
}
