"""Find test items in training texts, also where they were edited.

Rare word pairs of the items are the seeds. Documents keep the words around
seeds that they have; seeds join these passages to items, and Smith-Waterman
alignment of the words scores how much of an item a passage holds.

No pair that can reach the score is missed. Of an alignment take the gaps between
matched words, ``a`` words of the item left out and ``b`` of the document put in,
each at a cost of max(a, b). Let ``g`` gaps have a = 0 and b <= 1, so that the
item's pair is in the document, side by side or around one word. All others cost
at least a, or 2 where a = 0, so an item of n words scores at most
2 + 2g + (n - 1 - g) / 2, which bounds g from below. All but the commonest pairs of
an item are its seeds, so that at least two of the g are among them.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.tables import fresh, stored
from curbside.llm.wordhash import gram_hashes, word_hashes

# Items of fewer words are never found.
LEAST_WORDS = 3
# Seeds that an alignment has at least, if the item is long enough.
SHARED = 2
MIN_SCORE = 0.4
MATCH, MISMATCH, GAP = 2, -1, -1

# Bits of the filter before the join; its size is fixed.
_SLOTS = 1 << 22
# The passage filter has the classes of items that have a seed, and a last bit
# for items of which one seed is enough.
_MASKS, _CLASSES = 1 << 20, 63


def _packed(words: np.ndarray) -> bytes:
    """Words as four bytes each, which is enough to align them."""
    return (words >> np.uint64(32)).astype("<u4").tobytes()


def _sure(words: int, min_score: float) -> int:
    """Neighbouring pairs of an item in any text that reaches the score, at least."""
    return math.ceil((MATCH * min_score * words - words / 2 - 1.5) / 1.5 - 1e-9)


def _pairs(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of neighbouring words, and of words around one other."""
    near = gram_hashes(hashes, 2)
    # Every other word, from the first and from the second on.
    wide = np.zeros(max(len(hashes) - 2, 0), np.uint64)
    wide[::2], wide[1::2] = gram_hashes(hashes[::2], 2), gram_hashes(hashes[1::2], 2)
    return near, wide


def _item_pairs(hashes: np.ndarray, least: int, min_score: float) -> np.ndarray:
    """The pairs that may be seeds; of short items also those around a word.

    If no neighbouring pair is sure, a gap of a cost of 1 still is: else two
    matches would not score more than one.
    """
    if len(hashes) < least:
        return np.zeros(0, np.uint64)
    near, wide = _pairs(hashes)
    return near if _sure(len(hashes), min_score) > 0 else np.concatenate([near, wide])


def _items(least: int, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [word_hashes(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([_packed(h) for h in hashes], pa.binary()),
                    pa.array(
                        [_item_pairs(h, least, min_score).view(np.int64) for h in hashes],
                        pa.list_(pa.int64()),
                    ),
                ],
                names=["item", "words", "grams"],
            )

    return run


def _filter(grams: DataFrame) -> np.ndarray:
    """A bit set of hashes, put together in Spark from 64 bits a row."""
    slot = F.col("gram").bitwiseAND(_SLOTS - 1)
    bit = F.expr(f"shiftleft(1L, cast(gram & {63} as int))")
    rows = (
        grams.groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(bit).alias("bits"))
        .collect()
    )
    bits = np.zeros(_SLOTS // 64, np.uint64)
    for at, value in rows:
        bits[at] = np.uint64(value & 0xFFFFFFFFFFFFFFFF)
    octets = bits.astype("<u8").view(np.uint8)
    return np.unpackbits(octets, bitorder="little").astype(bool)


def _masks(seeds: DataFrame) -> np.ndarray:
    """For each slot of seeds the classes of their items, as bits."""
    kind = F.when(F.col("need") < SHARED, _CLASSES).otherwise(
        F.pmod(F.xxhash64("item_row"), F.lit(_CLASSES)).cast("int")
    )
    rows = (
        seeds.select(F.col("gram").bitwiseAND(_MASKS - 1).alias("at"), kind.alias("kind"))
        .groupBy("at")
        .agg(F.bit_or(F.expr("shiftleft(1L, kind)")).alias("bits"))
        .toArrow()
    )
    masks = np.zeros(_MASKS, np.uint64)
    masks[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return masks


def _count(bits: np.ndarray):
    """How often each pair that passes the filter occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column(0):
                grams = np.concatenate(_pairs(word_hashes(text.as_py())))
                found.append(grams[bits[grams & np.uint64(_SLOTS - 1)]])
            grams, times = np.unique(
                np.concatenate(found or [np.zeros(0, np.uint64)]), return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(times.astype(np.int64))],
                names=["gram", "n"],
            )

    return run


def _rarest(min_score: float):
    """The seeds of each item: all its pairs but the commonest ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seeds, items, times, needs = [], [], [], []
            for item, size, grams in zip(batch["item_row"], batch["size"], batch["grams"]):
                rank = sorted((g["n"], g["gram"]) for g in grams)
                sure = _sure(size, min_score)
                need = max(1, min(sure, SHARED))
                # So many others of the sure ones may be the commonest.
                chosen = Counter(x for _, x in rank[: len(rank) - max(sure - need, 0)])
                seeds += chosen.keys()
                times += chosen.values()
                items += [item] * len(chosen)
                needs += [need] * len(chosen)
            yield pd.DataFrame(
                {"gram": seeds, "item_row": items, "times": times, "need": needs}
            ).astype("int64")

    return run


def _in_reach(hits: np.ndarray, kinds: np.ndarray, reach: int) -> np.ndarray:
    """Whether a hit is enough, or another of a common class is within reach."""
    ok = kinds >> np.uint64(_CLASSES) != 0
    for step in range(1, len(hits)):
        near = hits[step:] - hits[:-step] <= reach
        if ok.all() or not near.any():
            break
        near &= kinds[step:] & kinds[:-step] != 0
        ok[step:] |= near
        ok[:-step] |= near
    return ok


def _passages(masks: np.ndarray, reach: int):
    """Words around the seeds of each document, overlapping parts as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            at, begins, lines, seeds = [], [], [], []
            for row, text in enumerate(batch.column(0)):
                hashes = word_hashes(text.as_py())
                near, wide = _pairs(hashes)
                of_near = masks[near & np.uint64(_MASKS - 1)]
                of_wide = masks[wide & np.uint64(_MASKS - 1)]
                kinds = of_near.copy()
                kinds[: len(wide)] |= of_wide
                hits = np.flatnonzero(kinds)
                if not len(hits):
                    continue
                hits = hits[_in_reach(hits, kinds[hits], reach)]
                if not len(hits):
                    continue
                for part in np.split(hits, np.flatnonzero(np.diff(hits) > 2 * reach) + 1):
                    low = max(0, int(part[0]) - reach)
                    high = int(part[-1]) + 3 + reach
                    at.append(row)
                    begins.append(low)
                    lines.append(_packed(hashes[low:high]))
                    apart = part[part < len(wide)]
                    grams = [near[part[of_near[part] != 0]], wide[apart[of_wide[apart] != 0]]]
                    seeds.append(np.unique(np.concatenate(grams)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1).take(pa.array(at, pa.int64())),
                    batch.column(2).take(pa.array(at, pa.int64())),
                    batch.column(3).take(pa.array(at, pa.int64())),
                    pa.array(begins, pa.int64()),
                    pa.array(lines, pa.binary()),
                    pa.array(seeds, pa.list_(pa.int64())),
                ],
                names=["id", "row", "sign", "begin", "words", "seeds"],
            )

    return run


def smith_waterman(lines: list[np.ndarray], items: list[np.ndarray]):
    """Best local alignment score of each pair, and where it ends in the line."""
    width, depth = max(map(len, lines)), max(map(len, items))
    doc = np.zeros((len(lines), width), np.uint32)
    use = np.zeros((len(lines), width), bool)
    # Word by word: what one step needs lies side by side.
    item = np.zeros((depth, len(items), 1), np.uint32)
    for i, (line, words) in enumerate(zip(lines, items)):
        doc[i, : len(line)], use[i, : len(line)] = line, True
        item[: len(words), i, 0] = words
    lengths = np.array([len(x) for x in items])
    # No sum is larger than a line's slope and an item's score.
    kind = np.int16 if width + MATCH * depth < 1 << 15 else np.int32
    slope = (-GAP * np.arange(width)).astype(kind)
    above = np.zeros((len(lines), width), kind)
    now, same = np.empty_like(above), np.empty(doc.shape, bool)
    best = np.zeros(len(lines), np.int64)
    end = np.zeros(len(lines), np.int64)
    rows = np.arange(len(lines))
    for k in range(depth):
        np.equal(doc, item[k], out=same)
        same &= use
        np.multiply(same.view(np.int8), kind(MATCH - MISMATCH), out=now, dtype=kind)
        now += MISMATCH
        now[:, 1:] += above[:, :-1]
        above += GAP
        np.maximum(now, above, out=now)
        np.maximum(now, 0, out=now)
        # A gap along the line: the best start to the left, less its length.
        now += slope
        np.maximum.accumulate(now, axis=1, out=now)
        now -= slope
        now[k >= lengths] = 0
        top = now.argmax(1)
        value = now[rows, top]
        better = value > best
        best[better], end[better] = value[better], top[better]
        above, now = now, above
    return best, end


def _align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [np.frombuffer(x.as_py(), "<u4") for x in batch.column(1)]
        items = [np.frombuffer(x.as_py(), "<u4") for x in batch.column(2)]
        score, end = np.zeros(len(lines), np.int64), np.zeros(len(lines), np.int64)
        order = sorted(range(len(lines)), key=lambda i: (len(items[i]), len(lines[i])))
        while order:
            # As many pairs at once as fit into a bounded array.
            n, widest = 0, 0
            for i in order:
                widest = max(widest, len(lines[i]))
                if n and widest * (n + 1) > 1 << 16:
                    break
                n += 1
            now, order = order[:n], order[n:]
            score[now], end[now] = smith_waterman(
                [lines[i] for i in now], [items[i] for i in now]
            )
        size = np.array([len(x) for x in items], np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[3:], pa.array(score), pa.array(size), pa.array(end)],
            names=[*batch.schema.names[3:], "raw", "item_words", "end"],
        )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    words: int = LEAST_WORDS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """``(id, sign, item, score, last_word)`` of documents with a test item.

    ``score`` is the alignment score over that of the whole item: 1 is a full
    copy, and words changed, left out or put in lower it. A document has one row
    for each item that reaches ``min_score``. Letters count without their case,
    and punctuation does not count. All such pairs are found if ``min_score`` is more
    than one matching word scores in the shortest item. ``sign`` is the xxhash64 of the text.

    Null and empty texts have no items and are none. Items of fewer than
    ``words`` words are too short to be told from other text and are never
    found. Rows that repeat an item or document have results of their own;
    an item's copies show up once for each distinct id. Other columns are not
    looked at, and empty tables give no rows.
    """
    id_kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    items = stored(
        benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("t"))
        .mapInArrow(
            _items(words, min_score), f"item {item_kind}, words binary, grams array<bigint>"
        )
        .where(F.size("grams") > 0)
        .distinct()
        .withColumn("item_row", F.monotonically_increasing_id()),
        "items",
    )
    grams = items.select("item_row", F.posexplode("grams").alias("i", "gram"))
    texts = docs.select(F.col(text_col).alias("t"))
    counts = (
        texts.mapInArrow(_count(_filter(grams)), "gram bigint, n bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )
    ranked = grams.join(counts, "gram", "left").groupBy("item_row").agg(
        F.collect_list(F.struct("i", F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias(
            "grams"
        )
    )
    sizes = items.select("item_row", F.expr("octet_length(words) div 4").alias("size"))
    seeds = stored(
        ranked.join(sizes, "item_row").mapInPandas(
            _rarest(min_score), "gram bigint, item_row bigint, times bigint, need bigint"
        ),
        "seeds",
    )
    # A passage reaches as far as the longest item may stretch: its own words, and
    # as many put in as the score allows.
    longest = items.agg(F.max(F.octet_length("words"))).first()[0] or 0
    reach = math.ceil(longest / 4 * (1 + MATCH * max(1 - min_score, 0)))
    numbered = docs.select(
        F.col(text_col).alias("t"),
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.xxhash64(text_col).alias("sign"),
    )
    passages = stored(
        numbered.mapInArrow(
            _passages(_masks(seeds), reach),
            f"id {id_kind}, row bigint, sign bigint, begin bigint, words binary,"
            " seeds array<bigint>",
        ),
        "passages",
    )
    hits = (
        passages.select("row", "begin", F.explode("seeds").alias("gram"))
        .join(seeds, "gram")
        .groupBy("row", "begin", "item_row")
        .agg(F.sum("times").alias("times"), F.first("need").alias("need"))
        .where(F.col("times") >= F.col("need"))
        .select("row", "begin", "item_row")
    )
    pairs = (
        hits.join(passages.drop("seeds"), ["row", "begin"])
        .withColumnRenamed("words", "line")
        .join(items.drop("grams"), "item_row")
        .select("row", "line", "words", "begin", "id", "sign", "item")
    )
    aligned = pairs.mapInArrow(
        _align,
        f"begin bigint, id {id_kind}, sign bigint, item {item_kind}, raw bigint,"
        " item_words bigint, end bigint",
    )
    found = aligned.select(
        "id",
        "sign",
        "item",
        (F.col("raw") / (MATCH * F.col("item_words"))).alias("score"),
        (-F.col("begin") - F.col("end")).alias("last"),
    ).where(F.col("score") >= min_score)
    # The best score, and of equal ones the first in the text.
    return (
        found.groupBy("id", "sign", "item")
        .agg(F.max(F.struct("score", "last")).alias("best"))
        .select("id", "sign", "item", "best.score", (-F.col("best.last")).alias("last_word"))
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    **options,
) -> DataFrame:
    """Pairs of document and item: id, item, ``score`` and ``last_word``.

    See :func:`find_leaks`. Rows of documents that repeat an id are one
    document here, with its best score.
    """
    found = find_leaks(
        docs, benchmark, id_col, text_col, item_col, item_text_col, **options
    )
    top = F.max(F.struct("score", "last_word"))
    return found.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_col)).agg(
        top["score"].alias("score"), top["last_word"].alias("last_word")
    )


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    **options,
) -> DataFrame:
    """The documents without any test item, with all their columns.

    See :func:`find_leaks`. A row goes if its own text has an item; rows that
    repeat an id are told apart by the hash of their text.
    """
    name, sign = fresh("id"), fresh("sign")
    hit = find_leaks(
        docs, benchmark, id_col, text_col, item_col, item_text_col, **options
    )
    hit = stored(
        hit.select(F.col("id").alias(name), F.col("sign").alias(sign)).distinct(), "hit"
    )
    return docs.join(
        hit,
        docs[id_col].eqNullSafe(hit[name]) & (F.xxhash64(docs[text_col]) == hit[sign]),
        "left_anti",
    )
