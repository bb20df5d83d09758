"""WARC archives: write them, normalise monolithic ones, read by offset.

An archive that was compressed as a whole can only be read from its start. The
normaliser inflates such a stream once, writes every record as a gzip member of
its own, and an index beside it says where each member lies.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm import files
from curbside.llm.tables import stored
from curbside.scratch import scratch_folder

MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 1 << 28
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_READ = 1 << 20


class Record(NamedTuple):
    """Headers by lower-case name, and the content block."""

    headers: dict[str, str]
    block: bytes


def _name(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page(name: str | None):
    text = re.fullmatch(r"<urn:x-page:(.*)>", name or "<urn:x-page:>")[1]
    return text or None


def build_record(page_id, url: str | None, payload: bytes, refers_to=None, revisit=False):
    """One uncompressed record around an HTTP answer with the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        # White space and control signs would break the header line.
        safe = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
        lines.append(f"WARC-Target-URI: {safe}")
    if revisit:
        lines += [f"WARC-Refers-To: {_name(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head = "\r\n".join(lines).encode("utf-8", "replace")
    return head + b"\r\n\r\n" + block + b"\r\n\r\n"


def inflated(stream) -> Iterator[bytes]:
    """Pieces of the content of a gzip stream of one or many members."""
    inflate = zlib.decompressobj(31)
    while raw := stream.read(_READ):
        while raw:
            out = inflate.decompress(raw, _READ)
            if out:
                yield out
            if inflate.eof:
                raw = inflate.unused_data
                inflate = zlib.decompressobj(31)
            else:
                raw = inflate.unconsumed_tail
    if out := inflate.flush():
        yield out


def split_records(pieces: Iterator[bytes]) -> Iterator[tuple[Record, bytes]]:
    """Records with their own bytes; holds one record at a time."""
    buffer = bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        if piece is None:
            return False
        buffer.extend(piece)
        return True

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("the archive ends within a record's header")
                return
        headers = {}
        lines = bytes(buffer[:end]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        for line in lines[1:]:
            key, _, value = line.partition(":")
            headers[key.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        total = end + 4 + size + 4
        while len(buffer) < total:
            if not more():
                raise ValueError("the archive ends within a record")
        yield (
            Record(headers, bytes(buffer[end + 4 : end + 4 + size])),
            bytes(buffer[:total]),
        )
        del buffer[:total]


def _archive(folder: str, archive_bytes: int):
    """Write rows as archives, each of them one gzip stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = out = pack = None
        size = count = 0

        def finish():
            out.write(pack.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"file": [name], "n_records": [count]})

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "first")]
            for page_id, url, html, first in zip(*columns):
                if out is None:
                    name, size, count = files.unique_name(".warc.gz"), 0, 0
                    out = files.open_write(f"{folder}/{name}")
                    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
                html, first = html.as_py() or "", first.as_py()
                record = build_record(
                    page_id.as_py(),
                    url.as_py(),
                    html.encode("utf-8", "surrogatepass"),
                    first,
                    first is not None,
                )
                out.write(pack.compress(record))
                size, count = size + len(record), count + 1
                if size >= archive_bytes:
                    yield finish()
                    out = None
        if out is not None:
            yield finish()

    return run


def _normalise(source: str, target: str):
    """Rewrite archives record by record, each with an index beside it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for old in batch["file"]:
                name = files.unique_name(".warc.gz")
                offset, rows = 0, []
                with (
                    files.open_stream(f"{source}/{old}") as stream,
                    files.open_write(f"{target}/{name}") as out,
                    files.open_write(f"{target}/{name}.idx") as index,
                ):
                    for record, raw in split_records(inflated(stream)):
                        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = pack.compress(raw) + pack.flush()
                        out.write(member)
                        row = (
                            offset,
                            len(member),
                            record.headers["warc-type"],
                            record.headers["warc-record-id"],
                            record.headers.get("warc-target-uri", "-"),
                        )
                        index.write("\t".join(map(str, row)).encode() + b"\n")
                        offset += len(member)
                        rows.append((name, *row[:4]))
                        if len(rows) >= 10_000:
                            yield pd.DataFrame(rows, columns=_INDEX)
                            rows = []
                yield pd.DataFrame(rows, columns=_INDEX)

    return run


_INDEX = ["file", "offset", "length", "record_type", "record_id"]


def normalise_archives(archives: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the archives ``file`` of a folder, one task for each.

    Returns the index ``(file, offset, length, record_type, record_id)``. The
    same lines, with the target address, lie beside each archive in a file
    ``.idx``. Memory holds one record at a time.
    """
    files.make_folder(target)
    names = archives.select("file").repartition("file")
    return stored(
        names.mapInPandas(
            _normalise(source, target),
            "file string, offset bigint, length bigint, record_type string,"
            " record_id string",
        ),
        "warc-index",
    )


def _read(folder: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, rows in batch.groupby("file"):
                out = []
                with files.open_read(f"{folder}/{name}") as file:
                    for offset, length in zip(rows["offset"], rows["length"]):
                        member = file.read_at(int(length), int(offset))
                        (record, _), *rest = split_records(
                            iter([zlib.decompress(member, 31)])
                        )
                        if rest:
                            raise ValueError("a member holds more than one record")
                        out.append(_facts(record))
                yield pd.DataFrame(out, columns=_FACTS)

    return run


_FACTS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]


def _facts(record: Record):
    head, _, payload = record.block.partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", head)[1])
    code = record.headers["warc-payload-digest"].removeprefix("sha1:")
    digest = base64.b32decode(code).hex()
    kind = record.headers["warc-type"]
    if kind == "response" and (
        len(payload) != size or hashlib.sha1(payload).hexdigest() != digest
    ):
        raise ValueError("a payload differs from its digest")
    refers_to = _page(record.headers.get("warc-refers-to"))
    page_id = _page(record.headers["warc-record-id"])
    return page_id, size, digest, kind, refers_to, record.headers.get("warc-target-uri")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """What the records of an index say, each read at its offset.

    Columns: ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to`` and ``url``. Payloads are held against their digests.
    """
    return index.select("file", "offset", "length").mapInPandas(
        _read(folder),
        "page_id string, payload_bytes bigint, payload_digest string,"
        " record_type string, refers_to string, url string",
    )


def plan_revisits(
    pages: DataFrame,
    id_col: str = "page_id",
    html_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
) -> DataFrame:
    """``(id, digest, first)`` of the pages that repeat the payload of ``first``.

    Of equal payloads of ``min_bytes`` or more the one with the largest id is the
    original. Null ids are smaller than all others.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    keys = pages.select(
        F.col(id_col).alias("id"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("bytes"),
    ).where(F.col("bytes") >= min_bytes)
    groups = (
        keys.groupBy("digest")
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .drop("n")
    )
    return (
        keys.distinct()
        .join(groups, "digest")
        .where(~F.col("id").eqNullSafe(F.col("first")))
        .select("id", "digest", "first")
    )


def archive_pages(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record for each page; returns ``(file, n_records)``.

    Every file is one gzip stream of about ``archive_bytes`` before compression.
    """
    files.make_folder(folder)
    plan = plan_revisits(pages, id_col, html_col, min_bytes)
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha"),
    )
    planned = rows.join(
        plan,
        rows["page_id"].eqNullSafe(plan["id"]) & (rows["sha"] == plan["digest"]),
        "left",
    )
    return stored(
        planned.select("page_id", "url", "html", "first").mapInArrow(
            _archive(folder, archive_bytes), "file string, n_records bigint"
        ),
        "archives",
    )


def round_trip(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_bytes: int = MIN_REVISIT_BYTES,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Archive all pages, normalise the archives, and read them back.

    One row per page: id, ``payload_bytes``, ``payload_digest`` (SHA-1 in hex),
    ``record_type``, ``refers_to`` and ``url``, in which white space and control
    signs are percent-encoded.

    Null html is an empty payload; a null url leaves its header out. Rows that
    repeat an id and payload are records of their own, all responses if the id
    is the largest of its group. Null ids are smaller than all others and refer
    to none. An empty table gives no rows, and other columns are not looked at.
    """
    spark = pages.sparkSession
    mono, single = scratch_folder(spark, "warc"), scratch_folder(spark, "warc-records")
    archives = archive_pages(
        pages, mono, id_col, url_col, html_col, min_bytes, archive_bytes
    )
    index = normalise_archives(archives, mono, single)
    found = read_archives(index, single)
    kind = pages.schema[id_col].dataType
    return found.select(
        F.col("page_id").cast(kind).alias(id_col),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "url",
    )
