"""Tables that a job writes and reads back, and names that cannot clash."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curbside.scratch import scratch_folder

# The bytes that the contracts call white space.
SPACE_RUN = r"[\x20\x09-\x0D]+"

# Numbers in the array by which rows are sorted out before a join.
SLOTS = 1 << 16


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder.

    This cuts the lineage: an executor that is lost takes no part of the table
    with it, and every later read sees the same rows in the same files.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str) -> str:
    """A column name that no table of the caller has."""
    return f"__{name}_{uuid4().hex[:12]}"


def same(left: DataFrame, right: DataFrame, *columns: str):
    """Join condition under which nulls are equal."""
    condition = F.lit(True)
    for column in columns:
        condition &= left[column].eqNullSafe(right[column])
    return condition


def shuffled(df: DataFrame) -> DataFrame:
    """The rows as a side of a join that is never sent to the driver to be broadcast.

    Spark takes rows that a function makes for as few as went into it, and a
    table for as large as its compressed files, so it may find them small enough.
    """
    return df.hint("merge")


def _bits(keys: DataFrame) -> Column:
    """An array of ``SLOTS`` numbers: the bits of the hashes in ``key``."""
    slots = keys.select(F.pmod("key", F.lit(64 * SLOTS)).alias("bit")).distinct()
    slots = slots.groupBy(F.shiftright("bit", 6).alias("slot")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("value")
    )
    slots = stored(slots, "bits")
    every = keys.sparkSession.range(SLOTS).select(F.col("id").alias("slot"))
    filled = every.join(slots, "slot", "left").select(
        F.struct("slot", F.coalesce("value", F.lit(0)).alias("value")).alias("s")
    )
    # A fixed number of rows: SLOTS.
    return filled.agg(F.array_sort(F.collect_list("s"))["value"].alias("a")).scalar()


def maybe_among(keys: DataFrame, key: Column) -> Column:
    """Whether a hash may be in the column ``key`` of ``keys``; never wrong if it is.

    Every task gets an array of a fixed size, so rows that cannot match stay
    where they are and only the others need to be shuffled.
    """
    bit = F.pmod(key, F.lit(64 * SLOTS))
    word = F.element_at(_bits(keys), (F.shiftright(bit, 6) + 1).cast("int"))
    return F.getbit(word, bit.bitwiseAND(63).cast("int")) == 1


def split_rows(
    rows: DataFrame, listed: DataFrame, columns: list[str], by: str
) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``columns`` are not in the table ``listed``, and those that are.

    Null equals null, and the table has every key once. Only rows whose column
    ``by`` may be listed are shuffled, and only for those all ``columns`` are
    worked out.
    """
    listed = stored(listed.select(*columns), "listed")
    may = maybe_among(listed.select(F.xxhash64(by).alias("key")), F.xxhash64(by))
    near, on = rows.where(may), same(rows, listed, *columns)
    others = rows.where(~may).unionByName(near.join(listed, on, "left_anti"))
    return others, near.join(listed, on, "left_semi")
