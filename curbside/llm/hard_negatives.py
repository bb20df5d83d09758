"""Hard negatives of anchors by exact integer scores from float32 products.

Vectors become integers, and their inner products are found modulo several
small primes: residues are so small that a float32 matrix product of them is
exact, and Chinese remaindering gives the signed score back. Scores decide an
anchor's positives first, then, in a window below each positive's score, its
negatives.

Anchors and rows are dealt to cells of bounded size, and each cell is one
matrix product. Positives only need cells of one label. What leaves a cell is
its best few rows for each anchor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbside.llm.tables import stored

SCALE = 256
CELL_ROWS = 1 << 12
CELL_ANCHORS = 1 << 12
# Anchors of a cell whose scores are held at once.
STRIP = 1 << 8
# Residues lie within 256 of zero; so many products of two add up exactly in float32.
TOP_PRIME = 512
EXACT_SUM = 1 << 24
# The product of the primes that such scores need fits into a long.
TOP_SCORE = 1 << 52
# Stands for a null id, which comes after all others.
NO_ID = (1 << 63) - 1


def small_primes(bound: int) -> list[int]:
    """The largest primes below ``TOP_PRIME`` whose product is above ``2 * bound``."""
    out, product, p = [], 1, TOP_PRIME
    while product <= 2 * bound + 1:
        p -= 1
        if all(p % d for d in range(2, int(p**0.5) + 1)):
            out.append(p)
            product *= p
    return out


def _residues(matrix: np.ndarray, p: int) -> np.ndarray:
    """Residues around zero as float32."""
    r = np.mod(matrix, p)
    return (r - p * (r > p // 2)).astype(np.float32)


def exact_products(left: np.ndarray, right: np.ndarray, primes: list[int]) -> np.ndarray:
    """``left @ right.T`` of int64 matrices, if twice any result is below the product.

    Mixed radix digits of the result are found prime by prime; they add up to a
    number from 0 on, of which the upper half stands for negative results.
    """
    width = max(1, EXACT_SUM // (TOP_PRIME // 2) ** 2)
    value, weight, digits = 0, 1, []
    for p in primes:
        a, b = _residues(left, p), _residues(right, p)
        found = np.zeros((len(left), len(right)), np.int32)
        for at in range(0, left.shape[1], width):
            part = a[:, at : at + width] @ b[:, at : at + width].T
            found = np.mod(found + part.astype(np.int32), p)
        # What the digits so far leave of the result modulo this prime.
        known, step = np.zeros_like(found), 1
        for digit, q in zip(digits, primes):
            known = np.mod(known + digit * np.int32(step), p)
            step = step * q % p
        digits.append(np.mod((found - known) * np.int32(pow(step, -1, p)), p))
        value = value + digits[-1].astype(np.int64) * weight
        weight *= p
    return value - weight * (value > weight // 2)


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    if not len(vectors):
        return np.zeros((0, 0), np.int64)
    sizes = np.array([len(v) for v in vectors])
    out = np.zeros((len(vectors), sizes.max()), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate(list(vectors))
    return out


def _same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def _first(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    if len(scores) > n:
        kept = np.flatnonzero(scores >= np.partition(scores, -n)[-n])
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:n]]


def _strips(anchors: pd.DataFrame, rows: pd.DataFrame, primes: list[int]):
    """Each anchor's number in its frame and its scores with the rows."""
    left, right = _same_width(_matrix(anchors["v"]), _matrix(rows["v"]))
    for at in range(0, len(left), STRIP):
        scores = exact_products(left[at : at + STRIP], right, primes)
        yield from enumerate(scores, at)


def _positives(primes: list[int], n: int):
    """Best rows of the anchors' own labels within a cell."""

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("anchor", "row", "place", "score")}
        tiles = dict(list(rows.groupby("tile")))
        for tile, some in anchors.groupby("tile"):
            if tile not in tiles:
                continue
            number, place = (tiles[tile][c].to_numpy() for c in ("row", "place"))
            anchor = some["row"].to_numpy()
            for i, scores in _strips(some, tiles[tile], primes):
                others = np.flatnonzero(number != anchor[i])
                best = others[_first(scores[others], place[others], n)]
                out["anchor"] += [anchor[i]] * len(best)
                out["row"] += number[best].tolist()
                out["place"] += place[best].tolist()
                out["score"] += scores[best].tolist()
        return pd.DataFrame(out)

    return run


def _negatives(primes: list[int], n: int, low: int, high: int):
    """Best rows of other labels in the window of each positive within a cell."""

    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        out = {c: [] for c in ("anchor", "nth", "row", "place", "score")}
        if not len(anchors) or not len(rows):
            return pd.DataFrame(out)
        number, place = rows["row"].to_numpy(), rows["place"].to_numpy()
        labels = rows["label"].to_numpy()
        anchor, own = anchors["row"].to_numpy(), anchors["label"].to_numpy()
        found = [np.array(p) for p in anchors["positives"]]
        for i, scores in _strips(anchors, rows, primes):
            # Window ends as scores: low * found <= 100 * score <= high * found.
            least, most = -(-low * found[i] // 100), high * found[i] // 100
            wide = (scores >= least.min()) & (scores <= most.max())
            some = np.flatnonzero(wide & (labels != own[i]))
            s, ids = scores[some], place[some]
            for nth in range(len(found[i])):
                inside = np.flatnonzero((s >= least[nth]) & (s <= most[nth]))
                best = inside[_first(s[inside], ids[inside], n)]
                out["anchor"] += [anchor[i]] * len(best)
                out["nth"] += [nth] * len(best)
                out["row"] += number[some[best]].tolist()
                out["place"] += ids[best].tolist()
                out["score"] += s[best].tolist()
        return pd.DataFrame(out)

    return run


def _spread(rows: DataFrame, own: str, other: str, parts, others) -> DataFrame:
    """Deal rows to one of ``parts`` and to each of the other side's ``others``."""
    return rows.withColumn(own, F.pmod(F.xxhash64("row"), parts)).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("long"), others - 1))
    )


def _apart(rows: DataFrame) -> DataFrame:
    """The rows under columns of their own, so that a table can meet itself."""
    return rows.select(*[F.col(c).alias(c) for c in rows.columns])


def _best(found: DataFrame, n: int, *keys: str) -> DataFrame:
    """The ``n`` best rows of each key, numbered from 1 in ``rank``."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "place", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _parts(count, size: int):
    return F.greatest(F.lit(1), F.ceil(count / size)).cast("long")


def best_positives(
    rows: DataFrame, primes: list[int], n: int, cell_rows: int, cell_anchors: int
) -> DataFrame:
    """``(anchor, row, place, score, rank)`` of the best rows with an anchor's label.

    A label with many rows is many tiles, and many small labels share a cell.
    """
    labels = (
        rows.groupBy("label")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"))
        .where("anchors > 0")
        .select(
            "label",
            _parts(F.col("n"), cell_rows).alias("rs"),
            _parts(F.col("anchors"), cell_anchors).alias("cs"),
        )
    )
    labelled = rows.join(labels, "label")
    dealt = labelled.agg(F.sum("cs")).first()[0] or 0
    # Finer than a tile, so that small labels spread over more tasks than they fill.
    cells = -(-8 * dealt // cell_rows) or 1
    tile = F.concat_ws("/", F.col("label").cast("string"), "r", "c")

    def cut(table: DataFrame):
        named = table.withColumn("tile", tile)
        cell = F.pmod(F.xxhash64("tile"), F.lit(cells)).alias("cell")
        return _apart(named.select(cell, "tile", "row", "place", "v")).groupBy("cell")

    anchors = _spread(labelled.where("anchor"), "c", "r", F.col("cs"), F.col("rs"))
    others = _spread(labelled, "r", "c", F.col("rs"), F.col("cs"))
    found = cut(anchors).cogroup(cut(others)).applyInPandas(
        _positives(primes, n), "anchor bigint, row bigint, place bigint, score bigint"
    )
    return _best(found, n, "anchor")


def hard_negatives(
    vectors: DataFrame,
    is_anchor,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cell_rows: int = CELL_ROWS,
    cell_anchors: int = CELL_ANCHORS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    Components become ``floor(scale * x)`` and scores are inner products. An
    anchor's positives are its ``positives`` best other rows of its label. For
    each, ``rank`` counts the best ``negatives`` rows of other labels with
    ``low * positive_score <= 100 * negative_score <= high * positive_score``.
    Higher scores come first, ties by smaller id. ``is_anchor`` is a condition
    on the columns of ``vectors``; ids are integers.

    Rows with a null label or vector, or a component that is null or not finite,
    take no part. A null condition is no anchor. Null ids come after all others.
    Rows that repeat an id are rows of their own, so such an anchor's results
    come as often as it does. A shorter vector ends in zeros. Anchors without
    positives or negatives and empty tables give no rows. Scores that could
    reach ``TOP_SCORE`` are an error. Other columns are not looked at.
    """
    finite = F.forall(vector_col, lambda x: F.abs(x.cast("double")) < float("inf"))
    scaled = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    rows = stored(
        vectors.where(F.col(label_col).isNotNull() & finite).select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("place"),
            F.monotonically_increasing_id().alias("row"),
            F.col(label_col).alias("label"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
            scaled.alias("v"),
        ),
        "vectors",
    )
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    size = rows.agg(
        F.max(square).alias("top"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if("anchor").alias("anchors"),
    ).first()
    # No score is larger than the largest square of a length.
    bound = int((size["top"] or 0.0) * (1 + 1e-9)) + 1
    if bound >= TOP_SCORE:
        raise ValueError(f"scores may reach {bound}, beyond {TOP_SCORE}")
    primes = small_primes(bound)
    found = stored(
        best_positives(rows, primes, positives, cell_rows, cell_anchors), "positives"
    )
    windows = found.groupBy("anchor").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda p: p["score"]
        ).alias("positives")
    )
    rs = F.lit(max(1, -(-size["rows"] // cell_rows))).cast("long")
    cs = F.lit(max(1, -(-size["anchors"] // cell_anchors))).cast("long")
    asked = rows.where("anchor").join(windows.withColumnRenamed("anchor", "row"), "row")
    asked = _spread(asked, "c", "r", cs, rs).select("r", "c", "row", "label", "v", "positives")
    asked = _apart(asked)
    others = _spread(rows, "r", "c", rs, cs).select("r", "c", "row", "place", "label", "v")
    mined = asked.groupBy("r", "c").cogroup(others.groupBy("r", "c")).applyInPandas(
        _negatives(primes, negatives, *window),
        "anchor bigint, nth int, row bigint, place bigint, score bigint",
    )
    best = _best(mined, negatives, "anchor", "nth").alias("n")
    ids = rows.where("anchor").select(F.col("row").alias("anchor"), "place").alias("a")
    pairs = found.select("anchor", (F.col("rank") - 1).alias("nth"), "place", "score").alias("p")

    def known(place: str):
        return F.nullif(F.col(place), F.lit(NO_ID))

    return (
        best.join(pairs, ["anchor", "nth"])
        .join(ids, "anchor")
        .select(
            known("a.place").alias("anchor_id"),
            known("p.place").alias("positive_id"),
            "n.rank",
            known("n.place").alias("negative_id"),
            F.col("p.score").alias("positive_score"),
            F.col("n.score").alias("negative_score"),
        )
    )
