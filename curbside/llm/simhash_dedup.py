"""Near duplicates by SimHash, found at the anchors of a covering code.

The anchors are the words of the Hamming code of 31 bits. It has covering
radius one: any 31 bits are an anchor or one bit away from exactly one. Of two
fingerprints that differ in at most two bits, either their low or their high
halves differ in at most one. So each half is replicated to every anchor within
radius plus threshold, two bits, and the pair meets at the home anchor of
either. Only there are all 64 bits compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.components import connected_components
from curbside.llm.tables import fresh, same, shuffled, split_rows, stored

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
# Fingerprints of an anchor that are compared by a join, and in one array.
PAIR_ROWS = 32
BLOCK = 8192

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """The SimHash of one text, over all its word shingles with repeats."""
    tokens = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    counts = np.zeros(2048, np.int64)
    total = max(1, len(tokens) - words + 1)
    hash64 = xxhash.xxh64_intdigest
    for start in range(0, total, 1 << 16):
        part = tokens[start : min(total, start + (1 << 16)) + words - 1]
        line = b" ".join(part)
        ends = np.cumsum(np.fromiter(map(len, part), np.int64, len(part)) + 1) - 1
        begins = np.concatenate([[0], ends[:-1] + 1])
        n = max(1, len(part) - words + 1)
        stops = ends[words - 1 :] if len(part) >= words else ends[-1:]
        hashes = np.fromiter(
            (
                hash64(line[a:b], SEED)
                for a, b in zip(begins[:n].tolist(), stops.tolist())
            ),
            np.uint64,
            n,
        )
        octets = hashes.view(np.uint8).reshape(n, 8) + _OFFSETS
        counts += np.bincount(octets.ravel(), minlength=2048)
    ones = (counts.reshape(8, 256) @ _BITS).ravel()
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little"), "little")


_OFFSETS = (np.arange(8) * 256).astype(np.int64)


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch.column(1)]
            signed = np.array(values, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(signed)], names=["id", "fp"]
            )

    return run


def simhash(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
) -> DataFrame:
    """``(id, fp)`` of every document, the fingerprint as a signed long."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        _fingerprints(words), f"id {kind}, fp bigint"
    )


def _code_tables() -> tuple[np.ndarray, np.ndarray]:
    """Syndromes of four octets, and for each syndrome the masks that lead
    from a word to the anchors within two bits. The home anchor comes first."""
    position = np.arange(1, 32)
    syndromes = np.zeros((4, 256), np.int64)
    for octet in range(4):
        for bit in range(8):
            if octet * 8 + bit < 31:
                on = (np.arange(256) >> bit) & 1
                syndromes[octet] ^= on * position[octet * 8 + bit]
    masks = np.zeros((32, 16), np.int64)
    for s in range(1, 32):
        pairs = [
            (1 << (i - 1)) | (1 << ((i ^ s) - 1)) for i in range(1, 32) if i < i ^ s
        ]
        masks[s] = [1 << (s - 1), *[m for m in pairs if m]][:16]
    return syndromes, masks


_SYNDROMES, _MASKS = _code_tables()


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(anchor, fp, home)``: each half at every anchor within two bits."""
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for start in range(0, len(fps), 1 << 15):
            part = fps[start : start + (1 << 15)]
            for side in (0, 1):
                half = (part >> np.uint64(32 * side)).astype(np.int64) & 0x7FFFFFFF
                s = np.zeros(len(half), np.int64)
                for octet in range(4):
                    s ^= _SYNDROMES[octet][(half >> (8 * octet)) & 255]
                # An anchor itself (syndrome zero) has no other within two bits.
                near = half[:, None] ^ _MASKS[s]
                use = (s[:, None] > 0) | (np.arange(16) == 0)
                home = np.broadcast_to(np.arange(16) == 0, near.shape)
                near = near | (side << 31)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(near[use]),
                        pa.array(np.repeat(part, use.sum(1)).view(np.int64)),
                        pa.array(home[use]),
                    ],
                    names=["anchor", "fp", "home"],
                )


def _links(max_bits: int):
    """Links ``(a, b)`` that connect what is close within one group."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        fps = group["fp"].to_numpy().view(np.uint64)
        home = fps[group["home"].to_numpy()]
        seen = fps[group["visits"].to_numpy()]
        a, b = _forest(home, seen, max_bits)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def _forest(home: np.ndarray, seen: np.ndarray, max_bits: int):
    """Each fingerprint with the first one of its component.

    The components are those of the links between the two lists; single
    fingerprints are left out, so there are fewer edges than fingerprints.
    """
    if not len(home) or not len(seen):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    nodes, at = np.unique(np.concatenate([home, seen]), return_inverse=True)
    home_at, seen_at = at[: len(home)], at[len(home) :]
    u, v = [], []
    for start in range(0, len(home), 256):
        part, part_at = home[start : start + 256], home_at[start : start + 256]
        close = np.bitwise_count(part[:, None] ^ seen[None, :]) <= max_bits
        linked = np.flatnonzero(close.any(0))
        close = close[:, linked]
        # A neighbour joins the first home that it is close to, and homes
        # with a common neighbour join each other.
        u.append(seen_at[linked])
        v.append(part_at[close.argmax(0)])
        common = close.astype(np.float32)
        x, y = np.nonzero(np.triu(common @ common.T, 1))
        u.append(part_at[x])
        v.append(part_at[y])
    u, v = np.concatenate(u), np.concatenate(v)
    label = np.arange(len(nodes))
    while True:
        new = label.copy()
        least = np.minimum(label[u], label[v])
        np.minimum.at(new, u, least)
        np.minimum.at(new, v, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[moved]], nodes[moved]


def fingerprint_links(
    fps: DataFrame, max_bits: int = MAX_BITS, pair_rows: int = PAIR_ROWS, block: int = BLOCK
) -> DataFrame:
    """Links ``(a, b)`` that connect distinct fingerprints ``fp``.

    Two fingerprints are connected by the links if and only if a chain of
    fingerprints leads from one to the other in steps of at most ``max_bits``
    bits, which must be two or fewer. Not every close pair is listed.

    The size of an anchor only decides how it is compared: up to ``pair_rows``
    by a join, beyond that in arrays, and with more than ``block`` fingerprints
    in blocks, where every block of home fingerprints meets every block of all.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("the anchors cover differences of two bits at most")
    placed = fps.select("fp").mapInArrow(
        _anchors, "anchor bigint, fp bigint, home boolean"
    )
    shared = (
        placed.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.max("home").alias("any_home"))
        .where("n > 1 and any_home")
        .select("anchor", "n")
    )
    # A fingerprint is at 32 anchors, so this is the largest table of the job.
    met = stored(shuffled(placed).join(shuffled(shared), "anchor"), "anchored")

    few = met.where(F.col("n") <= pair_rows)
    home = few.where("home").select("anchor", F.col("fp").alias("a"))
    every_few = few.select("anchor", F.col("fp").alias("b"))
    pairs = shuffled(home).join(shuffled(every_few), "anchor").where(
        (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        & (F.col("a") != F.col("b"))
    )

    parts = F.ceil(F.col("n") / block).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit("block")), parts).cast("int")
    many = met.where(F.col("n") > pair_rows).withColumns({"parts": parts, "mine": mine})
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    one = F.col("parts") == 1
    rows = many.where("home").select(
        "anchor", F.col("mine").alias("i"), every.alias("j"), "fp", "home",
        one.alias("visits"),
    )
    columns = many.where(~(F.col("home") & one)).select(
        "anchor", every.alias("i"), F.col("mine").alias("j"), "fp",
        F.lit(False).alias("home"), F.lit(True).alias("visits"),
    )
    arrays = (
        rows.unionByName(columns)
        .groupBy("anchor", "i", "j")
        .applyInPandas(_links(max_bits), "a bigint, b bigint")
    )
    return pairs.select("a", "b").unionByName(arrays)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: id, ``fingerprint`` in hex, ``component_id``.

    ``component_id`` is the smallest id that can be reached over fingerprints
    that differ in ``max_bits`` bits or fewer. Null and empty texts, and texts
    of white space, have the fingerprint zero and are linked like any other.
    A text of fewer than ``words`` words is one shingle. Rows may repeat an id.
    Null ids never name a component unless it has no other id. An empty table
    gives no rows, and other columns are not looked at.
    """
    prints = stored(simhash(docs, id_col, text_col, words), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected_components(fingerprint_links(distinct, max_bits))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = stored(rooted, "rooted")
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "root").select("fp", "component_id")
    return prints.join(classes, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The document with the smallest id of each component, all columns.

    See :func:`near_duplicates`. Of rows that repeat the smallest id with one
    fingerprint any one stays. A component whose ids are all null keeps one row.
    """
    name, mark, component, row = map(fresh, ("id", "fp", "component", "row"))
    found = near_duplicates(docs, id_col, text_col)
    stays = F.col(id_col).eqNullSafe(F.col("component_id"))
    ids = found.groupBy(F.col(id_col).alias(name)).agg(
        F.count(F.lit(1)).alias("n"), F.max(stays).alias("stays")
    )
    named = docs.withColumn(name, F.col(id_col))
    goes = stored(ids.where("n > 1 OR NOT stays"), "goes")
    others, _ = split_rows(named, goes, [name], name)
    once = others.select(*docs.columns)
    repeated = goes.where("n > 1 AND stays").select(name)
    if repeated.isEmpty():
        return once
    # Repeated ids: the fingerprint says which rows are of one component.
    _, odd = split_rows(named, repeated, [name], name)
    odd = stored(odd.withColumn(row, F.monotonically_increasing_id()), "odd")
    marks = simhash(odd, row, text_col).select(
        F.col("id").alias(row), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias(mark)
    )
    homes = found.select(
        F.col(id_col).alias(name),
        F.col("fingerprint").alias(mark),
        F.col("component_id").alias(component),
    ).distinct()
    marked = odd.join(marks, row)
    joined = marked.join(homes, same(marked, homes, name, mark)).select(
        *[marked[c] for c in marked.columns], homes[component]
    )
    mine = joined.where(F.col(name).eqNullSafe(F.col(component)))
    return once.unionByName(mine.dropDuplicates([name]).select(*docs.columns))
