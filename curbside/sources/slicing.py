"""Prefixes, bounded counts, and cutting a table in two at a row number."""

from __future__ import annotations

from itertools import islice

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from curbside.schemas import BOUNDED_SCAN_ROWS, PREFIX_ROWS

_N = "__n"
_KEY = "__key"

# So many rows are added up value by value; more are cut by splitters again.
_ROWS_AT_ONCE = 500_000
_SPLITTERS = 64
_SAMPLE_PER_SPLITTER = 32

# Copies of one row are written out in pieces of this many.
_COPIES_PER_TASK_ROW = 100_000


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """Any ``n`` rows, for a look at the data."""
    return df.limit(n)


def take_prefix(
    df: DataFrame,
    n: int = PREFIX_ROWS,
    order_by: str | list[str] | None = None,
    index: str | None = None,
) -> DataFrame:
    """The first ``n`` rows in an order, with a running ``index`` if named.

    Every task keeps its own best ``n``, so there is no full sort. A CSV scan
    has no order of its own, so without ``order_by`` any ``n`` rows come back.
    """
    if order_by is None:
        if index is not None:
            raise ValueError("an index needs order_by")
        return df.limit(n)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    first = df.orderBy(*keys).limit(n)
    if index is None:
        return first
    numbered = F.row_number().over(W.orderBy(*keys)) - 1
    return first.select(numbered.cast("long").alias(index), "*")


def count_prefix(df: DataFrame, n: int = BOUNDED_SCAN_ROWS) -> DataFrame:
    """Number of rows, or ``n`` if there are more, without reading much more.

    Tasks are started in batches, first one, then four times as many each time,
    until ``n`` rows are counted, and a task stops at ``n``. What no batch got to
    is never opened. Rows without columns are what leaves the scan, and a number
    what leaves a task.
    """
    rows = df.select(F.lit(True)).rdd
    parts, total, first, size = rows.getNumPartitions(), 0, 0, 1

    def count(part):
        return [sum(1 for _ in islice(part, n))]

    while first < parts and total < n:
        batch = range(first, min(parts, first + size))
        total += sum(df.sparkSession.sparkContext.runJob(rows, count, batch))
        first, size = batch.stop, size * 4
    return df.sparkSession.createDataFrame([(min(n, total),)], "n long")


def _key(df: DataFrame, columns: list[str]) -> Column:
    """The columns as one comparable value, with NULL first.

    Timestamps become microseconds, which a trip over the driver cannot shift.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(
        *[
            F.unix_micros(c).alias(c)
            if isinstance(kinds[c], TimestampType)
            else F.col(f"`{c}`")
            for c in columns
        ]
    )


def _splitters(part: DataFrame, key: Column, n_rows: int, seed: int) -> list:
    """A few values spread over the rows of ``part``, in order."""
    wanted = _SPLITTERS * _SAMPLE_PER_SPLITTER
    sample = part.select(key.alias(_KEY)).sample(min(1.0, wanted / n_rows), seed)
    nth = F.row_number().over(W.orderBy(_KEY)) % _SAMPLE_PER_SPLITTER
    chosen = sample.withColumn("__nth", nth).where("__nth = 0").select(_KEY).distinct()
    return chosen.orderBy(_KEY).collect()


def _boundary(
    df: DataFrame, columns: list[str], n_rows: int, total: int
) -> tuple[Column, int, int]:
    """The value of ``columns`` that holds row ``n_rows``, in their order.

    Returns it with the number of rows before it and the number of rows that
    share it. A sample gives splitters, and one scan counts the rows that lie
    between them or equal one: neither rows nor keys are shuffled, only counts.
    The part that holds the row is cut again until it is small enough to be
    added up value by value. Any splitters give the same answer.
    """
    spark = df.sparkSession
    key = _key(df, columns)
    kind = df.select(key.alias(_KEY)).schema
    part, before, rows = df, 0, total

    def value(row):
        return spark.createDataFrame([row], kind).select(_KEY).scalar()

    for seed in range(64):
        if rows <= _ROWS_AT_ONCE:
            break
        cuts = _splitters(part, key, rows, seed)
        if not cuts:
            continue
        every = spark.createDataFrame(cuts, kind).agg(
            F.array_sort(F.collect_list(_KEY)).alias("s")
        )
        placed = part.select(key.alias(_KEY), every.scalar().alias("__cuts"))
        below = F.size(F.filter("__cuts", lambda s: s < F.col(_KEY)))
        upto = F.size(F.filter("__cuts", lambda s: s <= F.col(_KEY)))
        counts = (
            placed.select(below.alias("below"), (upto - below).alias("equal"))
            .groupBy("below", "equal")
            .agg(F.count(F.lit(1)).alias(_N))
            .orderBy("below", "equal")
            .collect()
        )
        for found in counts:
            if before + found[_N] >= n_rows:
                break
            before += found[_N]
        at = found["below"]
        if found["equal"]:
            return value(cuts[at]), before, found[_N]
        rows = found[_N]
        if at > 0:
            part = part.where(key > value(cuts[at - 1]))
        if at < len(cuts):
            part = part.where(key < value(cuts[at]))

    counts = part.groupBy(key.alias(_KEY)).agg(F.count(F.lit(1)).alias(_N))
    holding = _first_reaching(counts, _KEY, n_rows - before)
    found = holding.first()
    value = spark.createDataFrame([found], holding.schema).select(_KEY).scalar()
    return value, before + found["upto"] - found[_N], found[_N]


def _first_reaching(counts: DataFrame, order_by: str, n_rows: int) -> DataFrame:
    """The row of a short table at which the running count reaches ``n_rows``."""
    upto = F.sum(_N).over(W.orderBy(order_by))
    reached = counts.withColumn("upto", upto).where(F.col("upto") >= n_rows)
    return reached.orderBy("upto").limit(1)


def _copies(df: DataFrame, row: DataFrame, n: int) -> DataFrame:
    """``n`` copies of a one-row table, made by many tasks."""
    if n == 0:
        return df.limit(0)
    pieces = -(-n // _COPIES_PER_TASK_ROW)
    size = F.least(
        F.lit(_COPIES_PER_TASK_ROW), F.lit(n) - F.col("__piece") * _COPIES_PER_TASK_ROW
    )
    every = F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))
    out = row.withColumn("__piece", F.explode(every))
    if pieces > 1:
        out = out.repartition(pieces, "__piece")
    copies = F.explode(F.sequence(F.lit(1), size.cast("int")))
    return out.withColumn("__copy", copies).select(*df.columns)


def split_at_row(
    df: DataFrame,
    n_rows: int,
    order_by: str | list[str],
    total: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The first ``n_rows`` rows in an order, and all the others.

    ``total`` is the number of rows where the caller knows it. Looks up the row
    at the cut and then filters on its value; the table is read a few times, but
    neither its rows nor all its keys are sorted or shuffled. Rows equal in ``order_by`` are
    ordered by all their columns; of identical rows the cut leaves a number on
    each side. Both parts depend on the values alone: whatever is run again,
    no row is in both parts or in none.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    if n_rows <= 0:
        return df.limit(0), df
    total = df.count() if total is None else total
    if n_rows >= total:
        return df, df.limit(0)

    key = _key(df, keys)
    cut, before, tied = _boundary(df, keys, n_rows, total)
    take = n_rows - before
    if take == tied:
        return df.where(key <= cut), df.where(key > cut)

    equal = df.where(key == cut)
    every = [*keys, *[c for c in df.columns if c not in keys]]
    whole = _key(df, every)
    row, before, copies = _boundary(equal, every, take, tied)
    same = equal.where(whole == row).limit(1)
    n_first = take - before
    first = df.where(key < cut).union(equal.where(whole < row))
    second = df.where(key > cut).union(equal.where(whole > row))
    return (
        first.union(_copies(df, same, n_first)),
        second.union(_copies(df, same, copies - n_first)),
    )
