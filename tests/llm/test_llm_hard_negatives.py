import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbside.llm.hard_negatives import (
    TOP_SCORE,
    exact_products,
    hard_negatives,
    small_primes,
)

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=3):
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and label is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]

    def product(a, b):
        return sum(x * y for x, y in zip(a, b))

    def first(found, n):
        return sorted(found, key=lambda f: (-f[1], f[0] is None, f[0] or 0))[:n]

    out = []
    for n, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % 50:
            continue
        scored = [(i, product(v, w), m) for k, (i, w, m) in enumerate(kept) if k != n]
        for pos, ps, _ in first([s for s in scored if s[2] == label], positives):
            window = [s for s in scored if s[2] != label and 50 * ps <= 100 * s[1] <= 95 * ps]
            for rank, (neg, ns, _) in enumerate(first(window, negatives), 1):
                out.append((anchor, pos, rank, neg, ps, ns))
    return Counter(out)


def vectors(seed, n, width=9, labels=3, spread=1.0):
    rng = random.Random(seed)
    rows = [
        (i * 10, [rng.gauss(0.2, spread) for _ in range(width)], rng.randrange(labels))
        for i in range(n)
    ]
    rows += [(r[0] + 1, r[1], r[2]) for r in rows[: n // 4]]
    return rows


def found(df, **more):
    return Counter(
        tuple(r)
        for r in hard_negatives(df, F.col("vec_id") % 50 == 0, **more).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        ).collect()
    )


def test_products_are_exact():
    rng = np.random.default_rng(1)
    for top, width in ((3, 1), (300, 70), (40_000, 600), (3_000_000, 40)):
        a, b = (rng.integers(-top, top + 1, (m, width)) for m in (5, 8))
        want = a.astype(object) @ b.T.astype(object)
        bound = top * top * width
        assert bound < TOP_SCORE
        assert (exact_products(a, b, small_primes(bound)) == want).all()
    extreme = np.array([[1 << 25]]), np.array([[1 << 25], [-(1 << 25)]])
    got = exact_products(*extreme, small_primes(1 << 50))
    assert got.tolist() == [[1 << 50, -(1 << 50)]]


@pytest.mark.parametrize("cells", [(7, 3), (1 << 12, 1 << 12)])
def test_matches_brute_force(spark, cells):
    rows = vectors(1, 60) + vectors(2, 30, labels=1)[:20]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, cell_rows=cells[0], cell_anchors=cells[1]) == brute(rows)


def test_one_label_and_one_vector_for_a_third(spark):
    rows = vectors(3, 80) + [(1000 + i, [0.5] * 9, 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df, cell_rows=16, cell_anchors=4) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = vectors(4, 30) + [
        (50, None, 1), (100, [1.0, None], 1), (150, [nan] * 9, 1), (200, [inf] * 9, 1),
        (250, [1.0] * 9, None), (None, [0.7] * 9, 1), (None, [0.7] * 9, 2), (300, [], 1),
        (350, [0.5, 0.25], 1), (0, [0.4] * 9, 1), (0, [0.4] * 9, 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "place", "anchor", "v", "rank", "score", "tile", "cell", "r", "c", "nth"):
        df = df.withColumn(name, F.lit(1))
    assert found(df, cell_rows=8) == brute(rows)
    assert not found(df.limit(0))
    with pytest.raises(ValueError):
        found(spark.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], SCHEMA))
