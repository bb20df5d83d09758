"""Alignment of two tokenizers over the same bytes.

Both tokenizers cut a text's bytes into tokens. Every token points to the
farthest-right token of the other side that overlaps it; doubling the pointers
until nothing moves leads each token to the last one of its group, where both
sides end together. Overlapping tokens are links, counted over the corpus by
their pair of ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.byte_pairs import encode, encoder_of, ranks_of
from curbside.llm.tables import stored

BYTE_LEVEL = "/opt/tokenizers/byte_bpe_50k.json"
PIECES = "/opt/tokenizers/piece_bpe_32k.model"
# Bytes of text that are aligned at once, unless one text is longer.
BATCH_BYTES = 1 << 19
# Pairs that a task counts before it passes its counts on.
HELD_PAIRS = 1 << 21
# Most frequent pairs whose counts every task gets; all others are joined.
KNOWN_PAIRS = 1 << 17


class ByteLevel:
    """Byte-level BPE; ``model`` is the JSON of a tokenizer."""

    def __init__(self, model: bytes):
        ranks = ranks_of(model)
        self.encoder = encoder_of(ranks)
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for entry, rank in ranks.items():
            self.bytes[rank] = entry

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of a blank and each text."""
        return [encode(self.encoder, " " + text) for text in texts]


class Pieces:
    """Sentence pieces with byte fallback; ``model`` puts the blank in front itself."""

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.pieces = SentencePieceProcessor(model_proto=model)
        n = len(self.pieces)
        names = [self.pieces.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(name[3:5], 16)])
            if self.pieces.is_byte(i)
            else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.pieces.encode(texts, num_threads=1)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every A token, then every B token, the last B token of its group.

    ``ends_*`` are ascending end offsets of two cuts of the same bytes.
    """
    n = len(ends_a)
    # The token of the other side that holds a token's last byte.
    over_a = np.searchsorted(ends_b, ends_a)
    over_b = np.searchsorted(ends_a, ends_b)
    last = ends_a[over_b] == ends_b
    successor = np.concatenate([n + over_a, np.where(last, n + np.arange(len(ends_b)), over_b)])
    while True:
        further = successor[successor]
        if np.array_equal(further, successor):
            return successor - n
        successor = further


class _Alignment:
    """Groups and links of several texts that both sides cut, over all of them at once."""

    def __init__(self, ids_a, ids_b, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.count_a, self.count_b = (
            np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b)
        )
        self.a, self.b = (
            np.concatenate([np.array(x, np.int64) for x in ids]) for ids in (ids_a, ids_b)
        )
        self.ends_a, self.ends_b = np.cumsum(sizes_a[self.a]), np.cumsum(sizes_b[self.b])
        last = terminals(self.ends_a, self.ends_b)
        # A text's end is an end of both sides, so no group reaches beyond it.
        self.final = np.flatnonzero(last[len(self.a) :] == np.arange(len(self.b)))
        group = np.searchsorted(self.final, last)
        self.in_a, self.in_b = group[: len(self.a)], group[len(self.a) :]
        self.text_ends = self.ends_b[np.cumsum(self.count_b) - 1]
        of_group = np.searchsorted(self.text_ends, self.ends_b[self.final])
        self.groups = np.bincount(of_group, minlength=len(self.count_a))

    def digests(self, words: np.ndarray) -> list[str]:
        """One digest a text; ``words`` has each id with either of its two signs."""
        a, b, n = self.a, self.b, len(self.final)
        # Each group's A tokens come before its B tokens.
        through_a = np.searchsorted(self.in_a, np.arange(n), "right")
        before_b = np.searchsorted(self.in_b, np.arange(n))
        order = np.empty(len(a) + len(b), np.int64)
        ends = np.diff(self.in_a, append=-1) != 0
        order[np.arange(len(a)) + before_b[self.in_a]] = 2 * a + ends
        ends = np.diff(self.in_b, append=-1) != 0
        order[np.arange(len(b)) + through_a[self.in_b]] = len(words) - 2 * (b + 1) + ends
        parts = words[order].tolist()
        cuts = np.cumsum(self.count_a + self.count_b)
        return [
            hashlib.sha256("".join(parts[start:end])[:-1].encode()).hexdigest()
            for start, end in zip(cuts - self.count_a - self.count_b, cuts)
        ]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The text and both tokens of each link; one lies between two neighbouring cuts."""
        cuts = np.sort(np.concatenate([self.ends_a, self.ends_b]), kind="stable")
        cuts = cuts[np.diff(cuts, prepend=-1) > 0]
        of_text, in_a, in_b = (
            np.searchsorted(ends, cuts) for ends in (self.text_ends, self.ends_a, self.ends_b)
        )
        return of_text, self.a[in_a], self.b[in_b]


class _Sides:
    """Both tokenizers with what they make of texts."""

    def __init__(self, model_a: bytes, model_b: bytes):
        self.a, self.b = ByteLevel(model_a), Pieces(model_b)
        self.sizes_a, self.sizes_b = (
            np.array([len(x) for x in side.bytes], np.int64) for side in (self.a, self.b)
        )
        words = [f"{i}{c}" for i in range(len(self.sizes_a)) for c in ",|"]
        words += [f"{i}{c}" for i in reversed(range(len(self.sizes_b))) for c in ",;"]
        self.words = np.array(words, object)

    def align(self, texts: list[str | None]) -> tuple[list[int], _Alignment | None]:
        """Which texts have tokens, and the alignment of those."""
        raw = {}
        for i, text in enumerate(texts):
            try:
                if text:
                    raw[i] = (" " + text).encode()
            except UnicodeEncodeError:
                continue
        if not raw:
            return [], None
        some = [texts[i] for i in raw]
        ids = {
            i: (x, y)
            for i, x, y in zip(raw, self.a.encode(some), self.b.encode(some))
            if b"".join([self.a.bytes[t] for t in x]) == raw[i]
            and b"".join([self.b.bytes[t] for t in y]) == raw[i]
        }
        if not ids:
            return [], None
        return list(ids), _Alignment(*zip(*ids.values()), self.sizes_a, self.sizes_b)


def _parts(batches: Iterator[pa.RecordBatch], batch_bytes: int):
    """Ids and texts of neighbouring rows with about as many bytes."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(False)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // batch_bytes)) + 1
        for part in np.split(np.arange(len(sizes)), cuts):
            ids, texts = (batch.column(i).slice(part[0], len(part)) for i in (0, 1))
            yield ids, texts.to_pylist()


_NUMBERS = {
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
    "pairs": pa.binary(),
    "times": pa.binary(),
}


def _linked(model_a: bytes, model_b: bytes, batch_bytes: int):
    """Each text's numbers, digest, and pairs of ids with how often they are linked."""

    def rows(texts, sides: _Sides):
        out = [(0, 0, 0, 0, "", b"", b"")] * len(texts)
        places, found = sides.align(texts)
        if not places:
            return out
        digests = found.digests(sides.words)
        of_text, a, b = found.links()
        span = len(sides.sizes_a) * len(sides.sizes_b)
        keys = np.sort(of_text * span + a * len(sides.sizes_b) + b)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        times, kinds = np.diff(first, append=len(keys)), keys[first]
        starts = np.searchsorted(kinds, np.arange(len(places) + 1) * span)
        kinds %= span
        for n, i in enumerate(places):
            part = slice(starts[n], starts[n + 1])
            numbers = (found.count_a[n], found.count_b[n], found.groups[n], times[part].sum())
            out[i] = (
                *map(int, numbers), digests[n], kinds[part].tobytes(), times[part].tobytes()
            )
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = None
        for ids, texts in _parts(batches, batch_bytes):
            sides = sides or _Sides(model_a, model_b)
            columns = zip(zip(*rows(texts, sides)), _NUMBERS.values())
            yield pa.RecordBatch.from_arrays(
                [ids, *[pa.array(c, kind) for c, kind in columns]], names=["id", *_NUMBERS]
            )

    return run


def _spans(model_a: bytes, model_b: bytes, batch_bytes: int):
    """A row for each group of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = None
        for ids, texts in _parts(batches, batch_bytes):
            sides = sides or _Sides(model_a, model_b)
            places, found = sides.align(texts)
            if not places:
                continue
            ends = found.ends_b[found.final]
            of_text = np.searchsorted(found.text_ends, ends)
            before = np.concatenate([[0], np.cumsum(found.groups)])[of_text]
            origin = np.concatenate([[0], found.text_ends])[of_text]
            starts = np.concatenate([[0], ends[:-1]])

            def lists(tokens, inside):
                cuts = np.searchsorted(inside, np.arange(len(ends) + 1))
                return pa.ListArray.from_arrays(cuts.astype(np.int32), tokens.astype(np.int32))

            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(np.array(places)[of_text])),
                    pa.array(np.arange(len(ends)) - before),
                    pa.array(starts - origin),
                    pa.array(ends - origin),
                    lists(found.a, found.in_a),
                    lists(found.b, found.in_b),
                ],
                names=["id", "nth", "start", "end", "a_ids", "b_ids"],
            )

    return run


def _counted(held: int):
    """Pairs with their sums over the rows that a task has read."""

    def summed(kinds: list, times: list) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate(kinds), return_inverse=True)
        sums = np.zeros(len(keys), np.int64)
        np.add.at(sums, at, np.concatenate(times))
        return keys, sums

    def batch_of(keys, sums) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, times, size = [], [], 0
        for batch in batches:
            for pairs, often in zip(batch.column(0), batch.column(1)):
                kinds.append(np.frombuffer(pairs.as_buffer(), np.int64))
                times.append(np.frombuffer(often.as_buffer(), np.int64))
                size += len(kinds[-1])
                if size > held:
                    keys, sums = summed(kinds, times)
                    if len(keys) > held // 2:
                        yield batch_of(keys, sums)
                        keys, sums = keys[:0], sums[:0]
                    kinds, times, size = [keys], [sums], len(keys)
        if size:
            yield batch_of(*summed(kinds, times))

    return run


def _looked_up(known: np.ndarray, counts: np.ndarray, best: np.ndarray):
    """Sums over a text's pairs that are known, and the other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_best, count_sum, rest, often = [], [], [], []
            for pairs, times in zip(batch.column(1), batch.column(2)):
                pairs = np.frombuffer(pairs.as_buffer(), np.int64)
                times = np.frombuffer(times.as_buffer(), np.int64)
                at = np.searchsorted(known, pairs)
                found = known[np.minimum(at, len(known) - 1)] == pairs
                count_sum.append(int((times * counts[at * found] * found).sum()))
                n_best.append(int((times * (best[at * found] & found)).sum()))
                rest.append(pairs[~found])
                often.append(times[~found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_best, pa.int64()),
                    pa.array(count_sum, pa.int64()),
                    pa.array(rest, pa.list_(pa.int64())),
                    pa.array(often, pa.list_(pa.int64())),
                ],
                names=["row", "n_best", "count_sum", "rest", "often"],
            )

    return run


def _model(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def token_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``(id, nth, start, end, a_ids, b_ids)``: every group of every document.

    ``start`` and ``end`` are byte offsets in a blank and the text. Documents
    without tokens, see :func:`align_tokenizers`, have no groups.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(
        _spans(_model(byte_level), _model(pieces), batch_bytes),
        f"id {kind}, nth bigint, start bigint, end bigint, a_ids array<int>, b_ids array<int>",
    ).withColumnRenamed("id", id_col)


def pair_counts(linked: DataFrame, pieces: int, held: int = HELD_PAIRS) -> DataFrame:
    """``(pair, n, best)``: links of each pair, and whether its B id has no pair with more.

    A pair is a number: the A id times ``pieces``, the size of B's vocabulary,
    and the B id.
    """
    counts = (
        linked.select("pairs", "times")
        .mapInArrow(_counted(held), "pair bigint, n bigint")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    counts = stored(counts.withColumn("b", F.col("pair") % pieces), "pairs")
    # One row for each id of B's vocabulary at most.
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "b").select(
        "pair", "n", (F.col("n") == F.col("most")).alias("best")
    )


def align_tokenizers(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_level: str = BYTE_LEVEL,
    pieces: str = PIECES,
    batch_bytes: int = BATCH_BYTES,
    known_pairs: int = KNOWN_PAIRS,
) -> DataFrame:
    """One row per document: how its two token sequences lie over each other.

    A is byte-level BPE of a blank and the text, B sentence pieces of the text;
    ``byte_level`` and ``pieces`` are their files, which the driver reads.
    Groups end where an A and a B token end together. A link is an A and a B
    token that share a byte. ``n_best`` counts links whose pair of ids has as
    many links in the corpus as any pair with that B id, and ``count_sum`` adds
    the links of the corpus up over the document's links. ``groups_sha256`` is
    of ``a1,a2|b1;a3|b2,b3``.

    Every task gets the counts of the ``known_pairs`` most frequent pairs; rarer
    ones are joined, so no pair is left out and no key of the join is frequent.

    Null and empty texts, and texts whose tokens do not give the text back byte
    by byte, have no tokens: zeros and an empty digest. Rows that repeat an id
    are rows of their own, an empty table gives no rows, and other columns are
    not looked at.
    """
    model_a, model_b = _model(byte_level), _model(pieces)
    kind = docs.schema[id_col].dataType.simpleString()
    linked = stored(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
        .mapInArrow(
            _linked(model_a, model_b, batch_bytes),
            f"id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
            " groups_sha256 string, pairs binary, times binary",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "linked",
    )
    counts = stored(pair_counts(linked, len(Pieces(model_b).bytes)), "counts")
    known = counts.orderBy(F.desc("n"), "pair").limit(known_pairs).toPandas()
    known = known.sort_values("pair")
    if not len(known):
        known.loc[0] = [-1, 0, False]
    sums = stored(
        linked.select("row", "pairs", "times").mapInArrow(
            _looked_up(
                known["pair"].to_numpy(np.int64),
                known["n"].to_numpy(np.int64),
                known["best"].to_numpy(bool),
            ),
            "row bigint, n_best bigint, count_sum bigint, rest array<bigint>,"
            " often array<bigint>",
        ),
        "sums",
    )
    rare = (
        sums.select("row", F.explode(F.arrays_zip("rest", "often")).alias("p"))
        .select("row", F.col("p.rest").alias("pair"), F.col("p.often").alias("times"))
        .join(counts, "pair")
        .select(
            "row",
            (F.col("times") * F.col("best").cast("long")).alias("n_best"),
            (F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    totals = (
        sums.select("row", "n_best", "count_sum")
        .unionByName(rare)
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return linked.join(totals, "row").select(
        F.col("id").alias(id_col),
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        "n_best",
        "count_sum",
        "groups_sha256",
    )
