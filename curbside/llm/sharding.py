"""Shards that balance bytes, tokens and rows together, by vector bin packing.

Groups of equal texts go to a shard as one. A group's hash deals it to one of
a fixed number of lots, and the totals of each lot are a vector of bytes,
tokens and rows. The largest vector comes first; each goes to the shard where
the dot product with what is left of the shard's capacity is highest.
A group that would fill most of a shard by itself is cut into pieces first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.mixing import word_count
from curbside.llm.tables import stored

SHARDS = 16
LOTS = 1 << 12
SIZES = ("size", "tokens", "rows")
# Bytes weigh more, as they are what the law is about.
WEIGHTS = (4, 1, 1)


def pack_vectors(vectors: np.ndarray, bins: int) -> np.ndarray:
    """The bin of each vector.

    Every bin has an equal share of the total of each dimension as capacity.
    Vectors are in units of that capacity, the largest sum comes first, and
    each goes to the bin with the highest dot product, weighted by ``WEIGHTS``,
    of the vector and what the bin has left, which may be less than nothing.
    Ties go to the vector and the bin that come first.
    """
    total = vectors.sum(axis=0, dtype=np.float64)
    share = vectors * (bins / np.where(total > 0, total, 1))
    left = np.ones((bins, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int64)
    for i in np.argsort(-share.sum(axis=1), kind="stable"):
        out[i] = np.argmax(left @ (share[i] * WEIGHTS))
        left[out[i]] -= share[i]
    return out


def _totals(units: DataFrame, *keys: str) -> DataFrame:
    return units.groupBy(*keys).agg(
        F.sum("size").alias("size"),
        F.sum("tokens").alias("tokens"),
        F.count(F.lit(1)).alias("rows"),
    )


def _measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """What placing needs to know of each row; no text is kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        word_count(text).alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("group"),
    )


def _large_groups(rows: DataFrame, shards: int, lots: int) -> DataFrame:
    """``(group, pieces)`` of the groups that are placed by themselves.

    Only lots with a large total can hold one, and there are few of those, so
    only their groups are counted one by one. There are at most ``48 * shards``.
    """
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SIZES[:2]]
    whole = rows.agg(*sums, F.count(F.lit(1)).alias("rows")).first().asDict()
    part = F.greatest(*[F.col(c) / F.lit(max(1, whole[c])) for c in SIZES])
    lot = F.pmod("group", F.lit(lots))
    crowded = _totals(rows.withColumn("lot", lot), "lot").where(part > 1 / (8 * shards))
    inside = rows.withColumn("lot", lot).join(
        F.broadcast(crowded.select("lot")), "lot", "left_semi"
    )
    # A group of up to half a shard stays whole, a larger one becomes quarters.
    pieces = F.when(part > 1 / (2 * shards), F.ceil(part * 4 * shards)).otherwise(1)
    return (
        _totals(inside, "group")
        .where(part > 1 / (16 * shards))
        .select("group", pieces.cast("long").alias("pieces"))
    )


def _with_units(rows: DataFrame, large: DataFrame, lots: int) -> DataFrame:
    """The rows with ``unit``, the name of what is placed as one."""
    piece = F.pmod(F.xxhash64("row"), "pieces")
    unit = F.when(
        F.col("pieces").isNull(), F.format_string("lot %d", F.pmod("group", F.lit(lots)))
    ).otherwise(F.format_string("group %d %d", "group", piece))
    joined = rows.join(F.broadcast(large), "group", "left")
    return joined.withColumn("unit", unit).drop("pieces")


def _packed(units: DataFrame, shards: int) -> DataFrame:
    """``(unit, shard)``; the number of units does not grow with the rows."""
    totals = _totals(units, "unit").orderBy("unit").toPandas()
    placed = pack_vectors(totals[[*SIZES]].to_numpy(np.int64), shards)
    return units.sparkSession.createDataFrame(
        [(u, int(s)) for u, s in zip(totals["unit"], placed)], "unit string, shard int"
    )


def _numbered():
    """Count the rows of each shard within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(0, np.int64)
        for batch in batches:
            shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            top = int(shard.max(initial=-1)) + 1
            seen = np.pad(seen, (0, max(0, top - len(seen))))
            order = np.argsort(shard, kind="stable")
            counts = np.bincount(shard, minlength=len(seen))
            nth = np.empty(len(shard), np.int64)
            nth[order] = np.arange(len(shard)) - np.repeat(np.cumsum(counts) - counts, counts)
            nth += seen[shard]
            seen += counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task] * len(shard), pa.int64()), pa.array(nth)],
                names=[*batch.schema.names, "task", "nth"],
            )

    return run


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lots: int = LOTS,
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``.

    ``size`` is the number of UTF-8 bytes and one more, ``tokens`` the number of
    words, and the shards are near equal in both and in rows. Documents of equal
    texts share a shard, as long as they fill no more than half of one. ``slot``
    numbers the rows of a shard from 0. The law that holds is ``bytes``;
    ``grown_shard`` is null, as it belongs to another law.

    The driver packs the totals of ``lots`` lots and of the few large groups,
    a number that does not grow with the documents. A single document is never
    cut, so with documents beyond a shard's share shards cannot be equal.

    Null texts are empty texts. Rows that repeat an id are rows of their own, an
    empty table gives no rows, and other columns are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = stored(_measured(docs, id_col, text_col), "sized")
    large = stored(_large_groups(rows, shards, lots), "large")
    units = _with_units(rows, large, lots)
    dealt = units.join(F.broadcast(_packed(units, shards)), "unit").select(
        "id", "row", "size", "tokens", "text_crc32", "shard"
    )
    numbered = stored(
        dealt.mapInArrow(
            _numbered(),
            f"id {kind}, row bigint, size bigint, tokens bigint, text_crc32 bigint,"
            " shard int, task bigint, nth bigint",
        ),
        "numbered",
    )
    counts = numbered.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("shard").orderBy("task")
    offsets = counts.select(
        "shard", "task", (F.sum("n").over(ahead) - F.col("n")).alias("first")
    )
    return numbered.join(offsets, ["shard", "task"]).select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("nth")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def write_shards(
    docs: DataFrame,
    folder: str,
    shards: int = SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lots: int = LOTS,
    shard_col: str = "shard",
) -> None:
    """Write the documents, all columns, as Parquet with a folder for each shard.

    ``shard_col`` names the folders and must not be a column of the documents.
    The texts are read twice and never shuffled. Copies of a text that is cut
    into pieces are dealt by their place in the table. See
    :func:`assign_shards` for what is balanced.
    """
    if shard_col.lower() in [c.lower() for c in docs.columns]:
        raise ValueError(f"the documents have a column {shard_col!r}")
    rows = stored(_measured(docs, id_col, text_col), "sized")
    large = stored(_large_groups(rows, shards, lots), "large")
    bins = stored(_packed(_with_units(rows, large, lots), shards), "bins")
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = docs.select(
        F.struct("*").alias("doc"),
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text).alias("group"),
    )
    dealt = _with_units(whole, large, lots).join(F.broadcast(bins), "unit")
    dealt.select("doc.*", F.col("shard").alias(shard_col)).write.partitionBy(
        shard_col
    ).mode("error").parquet(folder)
