"""A running number for every row of a table, in an order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbside.operators.joins import salt_of_row
from curbside.scratch import stored

_SALT, _PART, _N = "__salt", "__part", "__n"

# Parts whose counts one task adds up.
_WIDTH = 1024


def running_sums(counts: DataFrame, parts: int, width: int = _WIDTH) -> DataFrame:
    """``(__part, __first)``: what the parts ahead of each have in sum.

    ``counts`` has ``__part`` from 0 to ``parts`` - 1 and ``__n``. Sums run
    within blocks of ``width`` parts, and in the same way over the blocks.
    """
    blocked = counts.withColumn("__block", F.floor(F.col(_PART) / width))
    ahead = W.partitionBy("__block").orderBy(_PART)
    inside = blocked.select(_PART, "__block", (F.sum(_N).over(ahead) - F.col(_N)).alias("__first"))
    if parts <= width:
        return inside.drop("__block")
    blocks = blocked.groupBy(F.col("__block").alias(_PART)).agg(F.sum(_N).alias(_N))
    above = running_sums(blocks, -(-parts // width), width)
    above = above.select(F.col(_PART).alias("__block"), F.col("__first").alias("__above"))
    return inside.join(above, "__block").select(
        _PART, (F.col("__first") + F.col("__above")).alias("__first")
    )


def with_running_index(
    df: DataFrame,
    order_by: str | list[str],
    index: str = "row_index",
    parts: int | None = None,
    width: int = _WIDTH,
) -> DataFrame:
    """All rows with a running ``index`` from 0, in an order.

    Rows go to ranges of the order, each range counts its rows, and a row's
    number is that of its range's first row and its place within the range. No
    task sees more than a range, also where many rows are equal in ``order_by``:
    those are ordered by all their columns, and copies of a row are dealt out.
    NULL comes first. ``parts`` is the number of ranges, by default the
    session's shuffle partitions.
    """
    if index in df.columns:
        raise ValueError(f"there is a column {index!r} already")
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    plain = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    every = [F.col(f"`{c}`") for c in [*keys, *[c for c in plain if c not in keys]]]
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.withColumn(_SALT, salt_of_row(df, 1 << 30)).repartitionByRange(
        parts, *every, _SALT
    )
    placed = stored(ranged.withColumn(_PART, F.spark_partition_id()), "ranges")
    counts = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias(_N))
    firsts = running_sums(counts, parts, width)
    local = F.row_number().over(W.partitionBy(_PART).orderBy(*every, _SALT)) - 1
    numbered = placed.withColumn("__local", local).join(firsts, _PART)
    return numbered.select(
        (F.col("__first") + F.col("__local")).cast("long").alias(index),
        *[F.col(f"`{c}`") for c in df.columns],
    )
