"""Exact duplicates by an exchange of compressed fingerprints.

Every partition sorts the fingerprints of its rows and sends each owner of a
fingerprint range one Golomb-Rice code. An owner answers with one bitmap for
each code: set where another partition has the fingerprint as well. Only rows
so marked, or met twice within their partition, are suspects; only their texts
are compared, byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from curbside.llm import golomb
from curbside.llm.tables import SPACE_RUN, fresh, maybe_among, same, split_rows, stored

OWNER_HASHES = 1 << 20
BLOCK_ROWS = 1 << 20


def normal_text(text):
    """The text with each run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _sender(owners: int, block_rows: int):
    """Rows ``(block, owner, code, rows in the order of the code)``."""

    def pack(ids: pa.Array, shas: list[bytes], block: str) -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(shas), np.uint8).reshape(-1, 32)
        hashes = raw[:, :8].copy().view(">u8").ravel().astype(np.uint64)
        order = np.argsort(hashes, kind="stable")
        hashes, raw, ids = hashes[order], raw[order], ids.take(pa.array(order))
        # Upper halves times the number of owners: ranges of equal width.
        owner = ((hashes >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(owner)) + 1
        out = {name: [] for name in ("owner", "n", "k", "q", "r", "ids", "shas")}
        for part in np.split(np.arange(len(hashes)), cuts):
            distinct = np.unique(hashes[part])
            k, q, r = golomb.encode(distinct)
            out["owner"].append(int(owner[part[0]]))
            for name, value in zip("nkqr", (len(distinct), k, q, r)):
                out[name].append(value)
            out["ids"].append(ids.slice(part[0], len(part)).to_pylist())
            out["shas"].append(raw[part].tobytes())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block] * len(out["owner"])),
                pa.array(out["owner"], pa.int64()),
                pa.array(out["n"], pa.int32()),
                pa.array(out["k"], pa.int32()),
                pa.array(out["q"], pa.binary()),
                pa.array(out["r"], pa.binary()),
                pa.array(out["ids"], pa.list_(ids.type)),
                pa.array(out["shas"], pa.binary()),
            ],
            names=["block", "owner", "n", "k", "q", "r", "ids", "shas"],
        )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        held, shas = [], []
        for batch in batches:
            held.append(batch.column(0))
            shas += batch.column(1).to_pylist()
            if len(shas) >= block_rows:
                yield pack(pa.concat_arrays(held), shas, f"{part}-{number}")
                held, shas, number = [], [], number + 1
        if shas:
            yield pack(pa.concat_arrays(held), shas, f"{part}-{number}")

    return send


def _owner(codes: pd.DataFrame) -> pd.DataFrame:
    """One bitmap for each code: is the fingerprint in any other code?"""
    lists = [
        golomb.decode(n, k, q, r)
        for n, k, q, r in zip(codes["n"], codes["k"], codes["q"], codes["r"])
    ]
    merged = np.sort(np.concatenate(lists))
    repeated = np.unique(merged[1:][merged[1:] == merged[:-1]])
    bitmaps = [np.packbits(np.isin(x, repeated)).tobytes() for x in lists]
    return pd.DataFrame(
        {"block": codes["block"], "owner": codes["owner"], "bitmap": bitmaps}
    )


def _receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each code again, with what their bitmap says of them."""
    for batch in batches:
        for row in range(batch.num_rows):
            value = {c: batch.column(c)[row] for c in batch.schema.names}
            shas = value["shas"].as_py()
            ids = value["ids"].values
            raw = np.frombuffer(shas, np.uint8).reshape(-1, 32)
            hashes = raw[:, :8].copy().view(">u8").ravel()
            _, at, times = np.unique(hashes, return_inverse=True, return_counts=True)
            bits = np.frombuffer(value["bitmap"].as_py(), np.uint8)
            elsewhere = np.unpackbits(bits, count=len(times)).astype(bool)
            suspect = (elsewhere | (times > 1))[at]
            place = [
                f"{value['block'].as_py()}-{value['owner'].as_py()}-{i:07d}"
                for i in range(len(raw))
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array([shas[i : i + 32] for i in range(0, len(shas), 32)]),
                    pa.array(place),
                    pa.array(suspect),
                ],
                names=["id", "sha", "place", "suspect"],
            )


def fingerprint_exchange(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_hashes: int = OWNER_HASHES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: id, sha256 of the text, a unique place, suspect.

    A row is a suspect if its 64-bit fingerprint occurs more than once.
    ``owner_hashes`` is about how many fingerprints one owner holds, and
    ``block_rows`` how many rows one sender packs together.
    """
    owners = max(1, -(-docs.count() // owner_hashes))
    id_type = docs.schema[id_col].dataType
    keys = docs.select(
        F.col(id_col).alias("id"),
        F.unhex(F.sha2(normal_text(F.col(text_col)), 256)).alias("sha"),
    )
    sent = stored(
        keys.mapInArrow(
            _sender(owners, block_rows),
            StructType(
                [
                    StructField("block", StringType()),
                    StructField("owner", LongType()),
                    StructField("n", IntegerType()),
                    StructField("k", IntegerType()),
                    StructField("q", BinaryType()),
                    StructField("r", BinaryType()),
                    StructField("ids", ArrayType(id_type)),
                    StructField("shas", BinaryType()),
                ]
            ),
        ),
        "fingerprints",
    )
    codes = sent.select("block", "owner", "n", "k", "q", "r")
    bitmaps = codes.groupBy("owner").applyInPandas(
        _owner, "block string, owner bigint, bitmap binary"
    )
    answered = sent.select("block", "owner", "ids", "shas").join(
        bitmaps, ["block", "owner"]
    )
    return answered.mapInArrow(
        _receive,
        StructType(
            [
                StructField("id", id_type),
                StructField("sha", BinaryType()),
                StructField("place", StringType()),
                StructField("suspect", BooleanType()),
            ]
        ),
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = normal_text(F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("sha"),
    )


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_hashes: int = OWNER_HASHES,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: which row of its group of equal texts stays.

    Texts are equal when they are identical after each run of white space
    became one space. The columns are the id, ``keep_id``, ``group_size``,
    ``kept`` and ``text_sha256``.

    Null texts are empty texts, and empty texts equal each other. The smallest
    id stays; null ids are larger than all others. Of rows that repeat an id
    with an equal text exactly one is kept. An empty table gives no rows, and
    other columns are not looked at.
    """
    rows = stored(
        fingerprint_exchange(docs, id_col, text_col, owner_hashes, block_rows),
        "exchanged",
    )
    suspects = rows.where("suspect").select("id", "sha").distinct()
    # Texts of others stay where they are.
    ids = suspects.select(F.xxhash64("id").alias("key"))
    may = maybe_among(ids, F.xxhash64(F.col(id_col)))
    texts = _texts(docs.where(may), id_col, text_col)
    # Copies are counted before they are shuffled, so that many copies of one
    # text arrive as one row of each task.
    compared = (
        texts.join(suspects, same(texts, suspects, "id", "sha"), "left_semi")
        .groupBy("sha", "text")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    verified = stored(
        compared.groupBy("sha").agg(F.count(F.lit(1)).alias("texts")), "verified"
    )
    collided = verified.where("texts > 1").select("sha")
    # All others have a text of their own and stay where they are.
    alike = rows.where("suspect").withColumn("variant", F.lit(""))
    if not collided.isEmpty():
        # Different texts of one sha256: the text itself tells the groups apart.
        odd = texts.join(collided, "sha", "left_semi")
        named = odd.select("id", "sha", F.col("text").alias("variant")).distinct()
        alike = (
            alike.drop("variant")
            .alias("r")
            .join(named.alias("o"), same(alike, named, "id", "sha"), "left")
            .select("r.*", F.coalesce("o.variant", F.lit("")).alias("variant"))
        )
    first = F.struct(F.col("id").isNull().alias("none"), "id", "place")
    groups = alike.groupBy("sha", "variant").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("size")
    )
    sha = F.lower(F.hex("sha")).alias("text_sha256")
    grouped = alike.join(groups, ["sha", "variant"]).select(
        F.col("id").alias(id_col),
        F.col("first.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("place") == F.col("first.place")).alias("kept"),
        sha,
    )
    alone = rows.where("NOT suspect").select(
        F.col("id").alias(id_col),
        F.col("id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        sha,
    )
    return grouped.unionByName(alone)


def drop_exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents that stay, with all their columns.

    See :func:`exact_duplicates`. Of rows that repeat an id with an equal text
    any one stays.
    """
    id_name, sha = fresh("id"), fresh("sha")
    found = exact_duplicates(docs, id_col, text_col).where("group_size > 1")
    marked = stored(
        found.groupBy(F.col(id_col).alias(id_name), F.col("text_sha256").alias(sha)).agg(
            F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")
        ),
        "marked",
    )
    hashed = docs.withColumns(
        {id_name: F.col(id_col), sha: F.sha2(normal_text(F.col(text_col)), 256)}
    )
    # Rows that go, and rows of which one stays.
    goes = marked.where("NOT kept OR n > 1")
    others, _ = split_rows(hashed, goes, [id_name, sha], id_name)
    once = others.select(*docs.columns)
    repeated = marked.where("kept AND n > 1")
    if repeated.isEmpty():
        return once
    _, copies = split_rows(hashed, repeated, [id_name, sha], id_name)
    single = copies.dropDuplicates([id_name, sha])
    return once.unionByName(single.select(*docs.columns))
