import pytest
from pyspark.sql import functions as F

import curbside as cb
from curbside.operators.joins import broadcast_limit, bytes_of_rows, fits_broadcast


@pytest.mark.parametrize(
    "text,limit",
    [("10485760b", 10 << 20), ("10MB", 10 << 20), ("-1", -1), ("0", 0), ("2g", 2 << 30), ("4 KiB", 4096), ("1pb", 1 << 50)],
)
def test_limit_is_read_as_spark_writes_it(text, limit):
    class Spark:
        class conf:
            @staticmethod
            def get(*_):
                return text

    assert broadcast_limit(Spark) == limit


def test_size_grows_with_the_text(spark):
    short = spark.createDataFrame([("a", 1.0)] * 10, "k string, v double")
    long = spark.createDataFrame([("a" * 1000, 1.0)] * 10, "k string, v double")
    sizes = [df.agg(bytes_of_rows(df)).first()[0] for df in (short, long, short.limit(0))]
    assert sizes == [10 * (16 + 1 + 16 + 8), 10 * (16 + 1000 + 16 + 8), 0]
    nested = short.select(F.struct("k", "v").alias("s"))
    assert nested.agg(bytes_of_rows(nested)).first()[0] == 10 * (16 + 16 + 1 + 16 + 8)


def test_what_cannot_be_measured_is_not_broadcast(spark, conf):
    df = spark.createDataFrame([("a", [1])], "k string, v array<int>")
    assert df.agg(bytes_of_rows(df)).first()[0] is None
    assert not cb.is_small(df)
    assert not fits_broadcast(spark, None)


def test_limit_decides(spark, conf):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    assert cb.is_small(df)
    conf("spark.sql.autoBroadcastJoinThreshold", "1000b")
    assert not cb.is_small(df)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert not cb.is_small(df.limit(0))


@pytest.mark.parametrize("limit", ["10MB", "100b", "-1"])
def test_lookup_join_gives_the_same_rows_either_way(spark, conf, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    lookup = spark.createDataFrame([("hot", 1), ("3", 2), ("6", 3), ("6", 4), (None, 5)], "k string, w int")
    for how, n in (("inner", 1333 + 1 + 2), ("left", 2000 + 1)):
        got = cb.lookup_join(rows, lookup, "k", how)
        assert got.columns == ["k", "id", "w"]
        assert got.count() == n
        plain = rows.join(lookup, "k", how)
        assert got.exceptAll(plain).count() == 0


def test_salts_are_the_same_when_a_task_runs_again(spark):
    from curbside.operators.joins import salt_of_row

    df = spark.range(0, 1000, 1, 7).select(F.lit("same").alias("k"), (F.col("id") % 5).alias("v"))
    salted = df.select("k", "v", salt_of_row(df, 16).alias("salt"))
    first, again = ([tuple(r) for r in salted.collect()] for _ in range(2))
    assert first == again
    # Identical rows of different tasks still spread.
    assert len({salt for _, v, salt in first if v == 0}) > 1


@pytest.mark.parametrize("limit", ["10MB", "-1"])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "right", "full"])
def test_join_types_do_not_depend_on_size(spark, conf, how, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", limit)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", limit)
    rows = spark.range(200).select(
        F.when(F.col("id") < 150, 1).otherwise(F.col("id")).alias("k"), "id"
    )
    rows = rows.unionByName(spark.range(3).select(F.lit(None).cast("long").alias("k"), "id"))
    lookup = spark.createDataFrame([(1, "a"), (1, "b"), (170, "c"), (999, "d")], "k long, w string")
    if how in ("right", "full"):
        with pytest.raises(ValueError):
            cb.lookup_join(rows, lookup, "k", how)
        with pytest.raises(ValueError):
            cb.salted_join(rows, lookup, "k", how)
        return
    plain = rows.join(lookup, "k", how)
    for per_task in (10, 1_000_000):
        got = cb.lookup_join(rows, lookup, "k", how, rows_per_task=per_task)
        assert got.columns == plain.columns
        assert got.exceptAll(plain).count() == plain.exceptAll(got).count() == 0


def test_parts_follow_the_rows_of_a_key(spark):
    from curbside.operators.joins import crowded_keys

    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    found = {r[0]: r[1] for r in crowded_keys(rows, ["k"], 500).collect()}
    assert found == {0: 6}
    assert crowded_keys(rows, ["k"], 3000).isEmpty()


def test_no_task_gets_more_than_its_share_of_a_hot_key(spark, never_broadcast, conf):
    conf("spark.sql.shuffle.partitions", "40")
    conf("spark.sql.adaptive.enabled", "false")
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id"
    )
    lookup = spark.range(30_000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    joined = cb.salted_join(rows, lookup, "k", rows_per_task=500)
    per_task = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert joined.count() == 30_000
    assert per_task < 3_000
