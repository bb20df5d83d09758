"""Token counts of documents in flat files without an index.

A token file is nothing but ids of two bytes, each document followed by the
end-of-document id. Files are cut into blocks of equal size, every block is
searched for that id on its own, and a prefix scan over the blocks says where
the document that a block begins in has begun.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbside.llm import files
from curbside.llm.byte_pairs import encode, encoder_of
from curbside.llm.tables import stored
from curbside.scratch import scratch_folder

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50_256
BLOCK_TOKENS = 1 << 20

def _encoder(vocabulary: bytes):
    lines = (line.split() for line in vocabulary.splitlines() if line)
    return encoder_of({base64.b64decode(token): int(rank) for token, rank in lines})


def _write(vocabulary: bytes, folder: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, name, out, nth = None, files.unique_name(".bin"), None, 0
        for batch in batches:
            if out is None:
                encoder = _encoder(vocabulary)
                out = files.open_write(f"{folder}/{name}")
            for text in batch.column(0):
                text = (text.as_py() or "").encode("utf-8", "replace").decode()
                ids = [*encode(encoder, text), end]
                out.write(np.array(ids, "<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * batch.num_rows, pa.string()),
                    pa.array(np.arange(nth, nth + batch.num_rows)),
                    batch.column(1),
                ],
                names=["file", "nth", "id"],
            )
            nth += batch.num_rows
        if out is not None:
            out.close()

    return run


def write_token_files(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end: int = END,
) -> DataFrame:
    """Write a token file per partition; returns ``(file, nth, id)``.

    ``tokenizer`` is a file of ranks that the driver can read. Its vocabulary
    and ``end`` must fit into two bytes. The table says which document is the
    ``nth`` of which file, as the files themselves hold neither ids nor places.
    """
    with open(tokenizer, "rb") as ranks:
        vocabulary = ranks.read()
    files.make_folder(folder)
    id_kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(text_col).alias("t"), F.col(id_col).alias("id"))
    return stored(
        texts.mapInArrow(
            _write(vocabulary, folder, end), f"file string, nth bigint, id {id_kind}"
        ),
        "ledger",
    )


def _scan(folder: str, end: int, block: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, number in zip(batch["file"], batch["block"]):
                with files.open_read(f"{folder}/{name}") as file:
                    raw = file.read_at(2 * block, int(number) * 2 * block)
                ids = np.frombuffer(raw[: len(raw) // 2 * 2], "<u2")
                ends = np.flatnonzero(ids == end) + int(number) * block
                yield pd.DataFrame(
                    {
                        "file": [name],
                        "block": [number],
                        "n_tokens": [len(ids)],
                        "n_ends": [len(ends)],
                        "last_end": [ends[-1] if len(ends) else None],
                        "ends": [ends.astype(np.int64)],
                    }
                ).astype({"last_end": "Int64"})

    return run


def scan_token_files(
    spark: SparkSession,
    folder: str,
    names: DataFrame | None = None,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """``(file, nth, start, n_tokens, closed)`` of every document in the files.

    ``names`` may list in ``file`` which files of the folder count. ``n_tokens``
    leaves the end id out; a document of nothing but it has 0. What follows the
    last end id of a file is a document that is not ``closed``. An odd last byte
    is not an id and is left out.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.bin")
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")
    )
    if names is not None:
        listed = listed.join(names.select("file").distinct(), "file", "left_semi")
    count = F.ceil(F.floor(F.col("length") / 2) / block_tokens).cast("long")
    # The list of blocks is dealt out anew, so that a large file is many tasks.
    blocks = (
        listed.where(count > 0)
        .select("file", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("block"))
        .repartition("file", "block")
    )
    scanned = stored(
        blocks.mapInPandas(
            _scan(folder, end, block_tokens),
            "file string, block bigint, n_tokens bigint, n_ends bigint, last_end bigint,"
            " ends array<bigint>",
        ),
        "blocks",
    )
    before = (
        Window.partitionBy("file")
        .orderBy("block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summary = scanned.select("file", "block", "n_tokens", "n_ends", "last_end")
    placed = summary.select(
        "file",
        "block",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.max("last_end").over(before) + 1, F.lit(0)).alias("open"),
    )
    starts = F.concat(F.array("open"), F.transform("ends", lambda e: e + 1))
    found = scanned.join(placed, ["file", "block"]).where("n_ends > 0")
    found = found.select(
        "file", "first", F.posexplode(F.arrays_zip("ends", starts.alias("starts")))
    ).where(F.col("col.ends").isNotNull())
    closed = found.select(
        "file",
        (F.col("first") + F.col("pos")).alias("nth"),
        F.col("col.starts").alias("start"),
        (F.col("col.ends") - F.col("col.starts")).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    per_file = summary.groupBy("file").agg(
        F.sum("n_ends").alias("nth"),
        F.coalesce(F.max("last_end") + 1, F.lit(0)).alias("start"),
        F.sum("n_tokens").alias("tokens"),
    )
    rest = per_file.where("tokens > start").select(
        "file",
        "nth",
        "start",
        (F.col("tokens") - F.col("start")).alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(rest)


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer: str = TOKENIZER,
    end: int = END,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document: id and ``n_tokens``, read off flat token files.

    Null and empty texts have no tokens. Rows that repeat an id each have their
    own. Halves of surrogate pairs are replaced. An empty table gives no rows,
    and other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = scratch_folder(spark, "token-files")
    ledger = write_token_files(docs, folder, id_col, text_col, tokenizer, end)
    found = scan_token_files(spark, folder, ledger, end, block_tokens)
    return ledger.join(found, ["file", "nth"]).select(
        F.col("id").alias(id_col), "n_tokens"
    )
