import re

import pytest

import curbside as cb
from conftest import SMALL
from curbside import catalog, fixtures

PLACE = catalog.PLACE
SEVEN_DAYS = ("score_requests", "score_meter_days", "score_in_progress")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_no_python_and_no_cross_join(spark, conf, name, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    text = plan(catalog.QUERIES[name](spark, SMALL))
    for slow in ("PythonUDF", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert slow not in text
    # These broadcast the weekdays, at most seven, or their seconds.
    if limit == "-1" and name not in SEVEN_DAYS:
        assert "BroadcastHashJoin" not in text


@pytest.fixture
def whole_filters(conf):
    conf("spark.sql.maxMetadataStringLength", "10000")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('plans')}/sessions"
    cb.write_by_weekday(fixtures.typed_sessions(spark, SMALL), path)
    return spark.read.parquet(path)


def scans(text):
    return [line for line in text.splitlines() if "FileScan" in line]


def test_place_query_prunes_and_pushes(spark, table, whole_filters):
    meters = fixtures.meters(spark, SMALL)
    text = plan(cb.avg_meters_in_hour(table, meters, *PLACE, "Mon", 11))
    scan = next(line for line in scans(text) if "start_hour" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*Day_Of_Week[^\]]*= Mon", scan)
    for pushed in ("GreaterThanOrEqual(start_hour,9)", "LessThanOrEqual(start_hour,11)",
                   "GreaterThanOrEqual(end_hour,11)", "LessThanOrEqual(end_hour,17)"):
        assert pushed in scan
    columns = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert {c.split(":")[0] for c in columns.split(",")} == {
        "POST_ID", "EventDate", "start_hour", "end_hour",
    }


def test_place_box_is_pushed_to_a_stored_inventory(spark, tmp_path, whole_filters):
    fixtures.meters(spark, SMALL).write.parquet(f"{tmp_path}/meters")
    text = plan(cb.meters_within(spark.read.parquet(f"{tmp_path}/meters"), *PLACE))
    (scan,) = scans(text)
    assert "GreaterThanOrEqual(latitude," in scan and "LessThanOrEqual(longitude," in scan


def test_requests_prune_weekdays_at_run_time(spark, table):
    requests = cb.locate(fixtures.requests(spark, SMALL), fixtures.gazetteer(spark, SMALL))
    text = plan(cb.score_requests(requests, table, fixtures.meters(spark, SMALL)))
    assert "dynamicpruning" in text


def test_sessions_are_reduced_before_any_shuffle(spark, conf):
    sessions, meters = fixtures.typed_sessions(spark, SMALL), fixtures.meters(spark, SMALL)
    near_small = plan(cb.avg_sessions_at(sessions, meters, *PLACE, "Mon", "11:00:00"))
    assert "BroadcastHashJoin" in near_small
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(cb.avg_sessions_at(sessions, meters, *PLACE, "Mon", "11:00:00"))
    # The session side of the join is the aggregate per meter and date.
    join = text.index("SortMergeJoin")
    assert re.search(r"HashAggregate\(keys=\[POST_ID#\d+, EventDate#\d+\]", text[join:])


def test_parsing_happens_once_per_row(spark):
    text = plan(cb.clean_sessions(fixtures.raw_sessions(spark, SMALL)))
    assert text.count("gettimestamp(") == 2


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_plans_that_load_jobs_write(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    raw, meters = fixtures.raw_sessions(spark, SMALL), fixtures.raw_meters(spark, SMALL)
    for df in (
        cb.build_sessions(raw, meters),
        cb.attach_meter(cb.publishable(cb.clean_sessions(raw)), cb.meter_base(meters)),
    ):
        text = plan(df)
        assert ("BroadcastHashJoin" in text) == (limit != "-1")
        for slow in ("PythonUDF", "EvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert slow not in text


def test_scorers_launch_few_jobs_before_they_return(spark):
    requests = cb.locate(fixtures.requests(spark, SMALL), fixtures.gazetteer(spark, SMALL))
    sessions, meters = fixtures.typed_sessions(spark, SMALL), fixtures.meters(spark, SMALL)
    pivot = cb.hour_pivot(sessions)
    tracker = spark.sparkContext.statusTracker()
    for name, build in (
        ("requests", lambda: cb.score_requests(requests, sessions, meters)),
        ("possibility", lambda: cb.score_possibility(requests, pivot, meters, 19)),
    ):
        spark.sparkContext.setJobGroup(name, name)
        build()
        assert len(tracker.getJobIdsForGroup(name)) <= 20
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
