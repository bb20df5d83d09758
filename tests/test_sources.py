import random
from unittest.mock import MagicMock

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import curbside as cb
from conftest import SMALL
from curbside import fixtures
from curbside.schemas import HALF_FILE_SCHEMA, SESSION_COLUMNS, SESSION_SCHEMA
from curbside.scratch import scratch_folder
from curbside.sources import slicing


@pytest.fixture
def log(spark):
    return fixtures.raw_sessions(spark, SMALL).select(*SESSION_COLUMNS)


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


def test_csv_with_and_without_header(spark, log, tmp_path):
    cb.write_csv(log, f"{tmp_path}/a")
    assert same(log, cb.read_csv_sessions(spark, f"{tmp_path}/a"))
    half = log.select(F.lit("0").alias("NOT_IN_USE"), "*")
    cb.write_csv(half, f"{tmp_path}/b", header=False)
    back = cb.read_csv_sessions(spark, f"{tmp_path}/b", header=False)
    assert back.columns == HALF_FILE_SCHEMA.fieldNames()
    assert same(half, back)
    cb.write_csv(log, f"{tmp_path}/c", header=False)
    plain = cb.read_csv_sessions(spark, f"{tmp_path}/c", header=False, schema=SESSION_SCHEMA)
    assert same(log, plain)
    both = cb.read_csv_sessions(spark, [f"{tmp_path}/a", f"{tmp_path}/a"])
    assert both.count() == 2 * log.count()


def test_csv_append_and_error(spark, log, tmp_path):
    path = f"{tmp_path}/log"
    cb.write_csv(log, path)
    with pytest.raises(AnalysisException):
        cb.write_csv(log, path)
    cb.write_csv(log, path, mode="append")
    assert cb.read_csv_sessions(spark, path).count() == 2 * log.count()


def test_csv_columns_by_name(spark, log, tmp_path):
    extra = log.select(F.lit("x").alias("EXTRA"), *reversed(SESSION_COLUMNS))
    cb.write_csv(extra, f"{tmp_path}/a")
    assert same(log, cb.read_csv_sessions(spark, f"{tmp_path}/a"))
    few = log.select("SESSION_END_DT", "SESSION_START_DT", "POST_ID")
    cb.write_csv(few, f"{tmp_path}/b")
    assert cb.clean_sessions(cb.read_csv_sessions(spark, f"{tmp_path}/b")).count() == log.count()
    cb.write_csv(few.drop("POST_ID"), f"{tmp_path}/c")
    with pytest.raises(AnalysisException):
        cb.read_csv_sessions(spark, f"{tmp_path}/c")


def test_csv_with_two_headers_fails(spark, log, tmp_path):
    cb.write_csv(log, f"{tmp_path}/a")
    cb.write_csv(log.select(*reversed(SESSION_COLUMNS)), f"{tmp_path}/b")
    with pytest.raises(Exception, match="(?i)header"):
        cb.read_csv_sessions(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]).write.format("noop").mode(
            "overwrite"
        ).save()


def test_csv_meters(spark, tmp_path):
    raw = fixtures.raw_meters(spark, SMALL, as_text=True)
    cb.write_csv(raw.withColumn("OTHER", F.lit(1)), f"{tmp_path}/m")
    meters = cb.read_csv_meters(spark, f"{tmp_path}/m")
    assert same(cb.meter_base(meters), fixtures.meters(spark, SMALL))


@pytest.mark.parametrize("files", [None, 3])
def test_weekday_table_keeps_every_row(spark, tmp_path, files):
    sessions = fixtures.typed_sessions(spark, SMALL)
    undated = sessions.limit(5).withColumns(
        {"Day_Of_Week": F.lit(None).cast("string"), "start_hour": F.lit(None).cast("int")}
    )
    table = sessions.unionByName(undated)
    path = f"{tmp_path}/t"
    cb.write_by_weekday(table, path, files_per_weekday=files)
    back = spark.read.parquet(path).select(*table.columns)
    assert same(table, back)
    days = [cb.read_weekday(spark, path, day) for day in "mon Tue WED thu fri sat sun".split()]
    assert sum(d.count() for d in days) == sessions.count()
    assert back.where("Day_Of_Week IS NULL").count() == 5


def test_weekday_table_spreads_one_hot_meter(spark, conf, tmp_path):
    rows = spark.range(4000).select(
        F.lit("hot").alias("POST_ID"), F.lit("Mon").alias("Day_Of_Week"), F.lit(9).alias("start_hour")
    )
    cb.write_by_weekday(rows, f"{tmp_path}/salted", files_per_weekday=8)
    files = spark.read.parquet(f"{tmp_path}/salted").select(F.input_file_name()).distinct()
    assert files.count() > 3
    conf("spark.sql.adaptive.enabled", "false")
    cb.write_by_weekday(rows, f"{tmp_path}/plain")
    assert spark.read.parquet(f"{tmp_path}/plain").count() == 4000


def test_relational_reads_and_writes_pass_their_options():
    # No database is started here: only what reaches Spark's JDBC source.
    options = {"url": "jdbc:x:y", "user": "u", "batchsize": "500"}
    spark = MagicMock()
    cb.read_table(spark, options, "sessions")
    spark.read.jdbc.assert_called_once_with(
        "jdbc:x:y", "sessions", properties={"user": "u", "batchsize": "500"}
    )
    cb.read_table(spark, options, "sessions", "id", 0, 100, 4)
    assert spark.read.jdbc.call_args.kwargs == {
        "column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4,
        "properties": {"user": "u", "batchsize": "500"},
    }
    df = MagicMock()
    cb.write_table(df, options, "sessions")
    df.write.mode.assert_called_once_with("append")
    df = MagicMock()
    cb.write_table(df, options, "sessions", mode="overwrite")
    df.write.mode.return_value.option.assert_called_once_with("truncate", True)


def test_prefix(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("id"))
    first = cb.take_prefix(df, 500, "id", index="i")
    assert [tuple(r) for r in first.orderBy("i").collect()] == [(i, i) for i in range(500)]
    assert cb.take_prefix(df, 2000, ["id"]).count() == 1000
    assert cb.take_prefix(df, 7).count() == cb.preview(df, 7).count() == 7
    with pytest.raises(ValueError):
        cb.take_prefix(df, 5, index="i")


def test_bounded_count(spark):
    df = spark.range(0, 1000, 1, 16)
    assert cb.count_prefix(df).first().n == 1000
    assert cb.count_prefix(df, 10).first().n == 10
    assert cb.count_prefix(df.limit(0)).first().n == 0


def check_split(df, n, order_by, key):
    first, second = cb.split_at_row(df, n, order_by)
    assert first.columns == second.columns == df.columns
    rows = sorted((tuple(r) for r in df.collect()), key=key)
    a = sorted((tuple(r) for r in first.collect()), key=key)
    b = sorted((tuple(r) for r in second.collect()), key=key)
    n = max(0, min(n, len(rows)))
    assert len(a) == n
    assert a + b == rows or sorted(a + b, key=repr) == sorted(rows, key=repr)
    if a and b:
        assert key(a[-1])[0] <= key(b[0])[0]


@pytest.mark.parametrize("n", [-1, 0, 1, 333, 999, 1000, 5000])
def test_split_of_unique_rows(spark, n):
    ids = list(range(1000))
    random.Random(5).shuffle(ids)
    df = spark.createDataFrame([(i, f"v{i}") for i in ids], "id long, v string")
    check_split(df, n, "id", lambda r: r)


@pytest.mark.parametrize("n", [1, 100, 150, 250, 299, 300, 301, 450])
def test_split_among_ties_and_copies(spark, monkeypatch, n):
    # A third of the rows share the key, and most of those are identical.
    monkeypatch.setattr(slicing, "_ROWS_AT_ONCE", 20)
    monkeypatch.setattr(slicing, "_SPLITTERS", 4)
    monkeypatch.setattr(slicing, "_COPIES_PER_TASK_ROW", 16)
    rows = [(i, f"v{i}") for i in range(100)]
    rows += [(100, "copy")] * 120 + [(100, f"t{i:02d}") for i in range(80)]
    rows += [(None, "none")] * 10 + [(200 + i, None) for i in range(190)]
    random.Random(6).shuffle(rows)
    df = spark.createDataFrame(rows, "id long, v string")
    check_split(df, n, "id", lambda r: (-1 if r[0] is None else r[0], r[1] or ""))


def test_split_by_timestamp(spark):
    df = spark.range(100).select(
        F.timestamp_seconds(F.lit(1699174800) + F.col("id") * 60).alias("t"), "id"
    )
    first, second = cb.split_at_row(df, 40, "t")
    assert sorted(r.id for r in first.collect()) == list(range(40))
    assert second.count() == 60


def test_scratch_folder_is_new_each_time_and_shared(spark):
    a, b = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    base = spark.conf.get("spark.checkpoint.dir", None)
    assert a != b
    if base:
        assert a.startswith(base)
    else:
        assert a.startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_split_moves_no_rows_and_few_keys(spark, monkeypatch):
    monkeypatch.setattr(slicing, "_ROWS_AT_ONCE", 1000)
    df = spark.range(50_000).select((F.col("id") * 7919 % 50_000).alias("k"), "id")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("split", "split")
    first, second = cb.split_at_row(df, 20_000, "k", 50_000)
    shuffled = 0
    store = spark.sparkContext._jsc.sc().statusStore()
    for job in tracker.getJobIdsForGroup("split"):
        for stage in tracker.getJobInfo(job).stageIds:
            shuffled += store.lastStageAttempt(stage).shuffleWriteRecords()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert shuffled < 15_000
    assert first.count() == 20_000 and first.agg(F.max("k")).first()[0] == 19_999
    assert second.count() == 30_000 and second.agg(F.min("k")).first()[0] == 20_000


def test_many_copies_are_counted_in_long_numbers(spark):
    df = spark.createDataFrame([(1,)], "k int")
    copies = slicing._copies(df, df, 3_000_000_000)
    sizes = copies._jdf.queryExecution().analyzed().toString()
    assert "bigint" in sizes or "cast" in sizes
    assert slicing._copies(df, df, 250_001).count() == 250_001
