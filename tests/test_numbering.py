import random
import re

import pytest
from pyspark.sql import functions as F

import curbside as cb
from curbside.sources.numbering import running_sums

SCHEMA = "k string, a long, b double"


def rows(seed, n):
    rng = random.Random(seed)
    out = [(rng.choice(["x", "y", None, "hot", "hot"]), rng.randrange(30), rng.choice([0.5, None]))
           for _ in range(n)]
    return out + [("hot", 1, 0.5)] * (n // 2)


def order(row):
    return [(v is not None, v if v is not None else 0) for v in row]


@pytest.mark.parametrize("parts,width", [(1, 4), (7, 2), (20, 3)])
def test_numbers_follow_the_order(spark, parts, width):
    data = rows(1, 300)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = cb.with_running_index(df, ["k", "a"], parts=parts, width=width).collect()
    assert sorted(r.row_index for r in got) == list(range(len(data)))
    numbered = [(r.k, r.a, r.b) for r in sorted(got, key=lambda r: r.row_index)]
    assert numbered == sorted(data, key=order)


def test_many_equal_rows_and_empty_tables(spark):
    df = spark.createDataFrame([("hot", 1, 0.5)] * 200, SCHEMA)
    got = cb.with_running_index(df, "k", parts=4).collect()
    assert sorted(r.row_index for r in got) == list(range(200))
    assert cb.with_running_index(df.limit(0), "k").collect() == []
    with pytest.raises(ValueError):
        cb.with_running_index(df, "k", index="a")
    with pytest.raises(ValueError):
        cb.write_csv(df, "never", index="n")


def test_sums_over_blocks_of_blocks(spark):
    counts = [(i, i % 5) for i in range(100) if i % 7]
    df = spark.createDataFrame(counts, "__part int, __n long")
    got = {r[0]: r[1] for r in running_sums(df, 100, 3).select("__part", "__first").collect()}
    assert got == {p: sum(n for q, n in counts if q < p) for p, _ in counts}


def test_no_window_without_a_partition(spark):
    df = spark.createDataFrame(rows(2, 50), SCHEMA)
    text = cb.with_running_index(df, "a", parts=9, width=2)._jdf.queryExecution().toString()
    windows = re.findall(r"windowspecdefinition\(([^)]*)", text)
    assert windows and all("__part" in w or "__block" in w for w in windows)
    assert "SinglePartition" not in text


def test_counting_stops_early(spark, conf, tmp_path):
    """Files that are gone by then would fail the count if it got to them."""
    conf("spark.sql.files.maxPartitionBytes", "2k")
    conf("spark.sql.files.openCostInBytes", "1k")
    path = tmp_path / "log"
    spark.range(20_000).repartition(200).write.csv(str(path))
    df = spark.read.schema("id string").csv(str(path))
    of_part = df.select(F.spark_partition_id(), "_metadata.file_name").distinct().collect()
    assert len({part for part, _ in of_part}) >= 100
    # Two batches: parts 0, and 1 to 4.
    needed = {name for part, name in of_part if part < 5}
    assert len(needed) <= 10
    for _, name in of_part:
        if name not in needed:
            (path / name).unlink(missing_ok=True)
    assert cb.count_prefix(df, 300).first().n == 300
    with pytest.raises(Exception):
        cb.count_prefix(df, 10_000)


def test_counts_of_short_tables(spark):
    assert cb.count_prefix(spark.range(0), 5).first().n == 0
    assert cb.count_prefix(spark.range(7).repartition(4), 5).first().n == 5
    assert cb.count_prefix(spark.range(7).repartition(40), 100).first().n == 7
    assert cb.count_prefix(spark.range(7), 0).first().n == 0
