"""Joins that hold when one key has a third of all rows.

A side is broadcast only after its size was measured against the session's own
limit (``spark.sql.autoBroadcastJoinThreshold``). Beyond the limit the join is
shuffled. Keys with more rows than one task should get are counted first, and
only these are cut into parts: as many as their rows need, whatever the data.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DatetimeType,
    DecimalType,
    NumericType,
    StringType,
    StructType,
)

from curbside.scratch import stored

# Rows of one key that a single task may get.
ROWS_PER_TASK = 1_000_000

# Rows that a list of ``gathered`` has on average at most.
LIST_ROWS = 256

# Joins in which an unmatched lookup row cannot show, however often it is repeated.
LOOKUP_JOINS = ("inner", "left", "left_semi", "left_anti")

_SIZE = re.compile(r"(-?\d+)\s*([kmgtp]?)i?b?", re.IGNORECASE)
_UNITS = {"": 1} | {unit: 1 << 10 * i for i, unit in enumerate("kmgtp", start=1)}

_SALT = "__salt"
_PARTS = "__parts"


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast limit in bytes; zero or less means never."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB")
    found = _SIZE.fullmatch(text.strip())
    if found is None:
        raise ValueError(f"not a size: {text!r}")
    return int(found[1]) * _UNITS[found[2].lower()]


def _width(value: str, kind: DataType, lists: bool = False) -> str | None:
    """SQL for the bytes of a value in a row; None where only the data could tell.

    ``lists`` walks through arrays as well.
    """
    if isinstance(kind, (StringType, BinaryType)):
        return f"coalesce(octet_length({value}), 0) + 16"
    if isinstance(kind, StructType):
        return _row_width(kind, f"{value}.", lists)
    if lists and isinstance(kind, ArrayType):
        each = _width("x", kind.elementType, lists)
        added = f"aggregate({value}, 24L, (s, x) -> s + {each})"
        return None if each is None else f"coalesce({added}, 24L)"
    if isinstance(kind, (NumericType, DatetimeType, BooleanType)):
        return "16" if isinstance(kind, DecimalType) else "8"
    return None


def _row_width(row: StructType, prefix: str = "", lists: bool = False) -> str | None:
    widths = [_width(f"{prefix}`{f.name}`", f.dataType, lists) for f in row.fields]
    return None if None in widths else " + ".join(["16L", *widths])


def bytes_of_rows(df: DataFrame, lists: bool = False) -> Column:
    """Aggregate for the size of the rows as Spark holds them, NULL if unknown."""
    width = _row_width(df.schema, lists=lists)
    return F.expr("CAST(NULL AS BIGINT)" if width is None else f"coalesce(sum({width}), 0L)")


def fits_broadcast(spark: SparkSession, size: int | None) -> bool:
    """Whether a measured size is within the session's broadcast limit."""
    limit = broadcast_limit(spark)
    return size is not None and 0 < limit and size <= limit


def is_small(df: DataFrame, lists: bool = False) -> bool:
    """True when the measured size is within the session's broadcast limit.

    Runs one job over ``df``; used on dimension tables, never on session data.
    """
    spark = df.sparkSession
    if df.isStreaming or broadcast_limit(spark) <= 0:
        return False
    return fits_broadcast(spark, df.agg(bytes_of_rows(df, lists)).first()[0])


def salt_of_row(df: DataFrame, salts: int) -> Column:
    """A salt that a rerun of the same task gives again.

    The partition number takes part, so even identical rows are spread.
    """
    plain = [
        f"`{field.name}`"
        for field in df.schema.fields
        if field.dataType.typeName() not in ("map", "variant")
    ]
    values = ", ".join(["spark_partition_id()", *plain])
    return F.expr(f"CAST(pmod(xxhash64({values}), {salts}) AS INT)")


def crowded_keys(
    rows: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keys with more than ``rows_per_task`` rows, and the ``__parts`` they need.

    Counted with a map-side combine, so a hot key costs one line per task. The
    result has at most one line per ``rows_per_task`` rows of the input.
    """
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    counts = rows.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    parts = F.ceil(F.col("__rows") / rows_per_task).cast("int").alias(_PARTS)
    return counts.where(F.col("__rows") > rows_per_task).select(*keys, parts)


def gathered(rows: DataFrame, keys: list[str], most: int = LIST_ROWS) -> DataFrame:
    """The other columns as ``__rows``, a list of structs, for each key.

    A key with more than ``most`` rows has several lines, each with its
    ``__list`` number, so that no line grows with the input. ``inline`` gives
    the rows back. Keys must not be NULL.
    """
    others = [f"`{c}`" for c in rows.columns if c not in keys]
    crowded = stored(crowded_keys(rows, keys, most), "crowded")
    number = F.lit(0)
    if not crowded.isEmpty():
        dealt = salt_of_row(rows, 1 << 30)
        if is_small(crowded):
            crowded = F.broadcast(crowded)
        rows = rows.withColumn("__dealt", dealt).join(crowded, keys, "left")
        number = F.col("__dealt") % F.coalesce(F.col(_PARTS), F.lit(1))
    # A list of structs without a field is none.
    row = F.struct(*(others or [F.lit(0).alias("__none")])).alias("__row")
    return (
        rows.select(*keys, number.alias("__list"), row)
        .groupBy(*keys, "__list")
        .agg(F.collect_list("__row").alias("__rows"))
    )


def _check_join(how: str) -> str:
    name = how.lower().replace("_", "").removesuffix("outer")
    name = {"leftsemi": "left_semi", "semi": "left_semi",
            "leftanti": "left_anti", "anti": "left_anti"}.get(name, name)
    if name not in LOOKUP_JOINS:
        raise ValueError(f"a lookup join is one of {LOOKUP_JOINS}, not {how!r}")
    return name


def salted_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Shuffled join of many rows per key to few rows per key.

    The rows of a crowded key are dealt into the parts that their number needs,
    and ``lookup`` is repeated for each part of such a key alone, so every row
    still meets every match exactly once. Rows without a key match nothing and
    are spread as well. ``how`` is one of ``LOOKUP_JOINS``.
    """
    how = _check_join(how)
    keys = [on] if isinstance(on, str) else list(on)
    if rows.isStreaming:
        return rows.join(lookup, keys, how)
    crowded = stored(crowded_keys(rows, keys, rows_per_task), "crowded")
    if crowded.isEmpty():
        return rows.join(lookup, keys, how)
    # One line per rows_per_task rows at most, but its size is checked all the same.
    if is_small(crowded):
        crowded = F.broadcast(crowded)
    parts = F.coalesce(F.col(_PARTS), F.lit(1))
    dealt = salt_of_row(rows, 1 << 30)
    left = rows.withColumn("__dealt", dealt).join(crowded, keys, "left")
    left = left.withColumn(_SALT, F.col("__dealt") % parts)
    right = lookup.join(crowded, keys, "left").withColumn(
        _SALT, F.explode(F.sequence(F.lit(0), parts - 1))
    )
    joined = left.drop("__dealt", _PARTS).join(
        right.drop(_PARTS), [*keys, _SALT], how
    )
    return joined.drop(_SALT)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | list[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join many rows to a dimension table: broadcast if small, else shuffled.

    ``how`` is one of ``LOOKUP_JOINS``; which way is taken does not show in the
    result.
    """
    how = _check_join(how)
    if is_small(lookup):
        return rows.join(F.broadcast(lookup), on, how)
    return salted_join(rows, lookup, on, how, rows_per_task)
