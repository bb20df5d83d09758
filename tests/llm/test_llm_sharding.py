import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from texts import EDGES, corpus, table

from curbside.llm.sharding import WEIGHTS, assign_shards, pack_vectors, write_shards


def plain_pack(vectors, bins):
    total = [sum(v[d] for v in vectors) or 1 for d in range(3)]
    share = [[x * bins / t for x, t in zip(v, total)] for v in vectors]
    left, out = [[1.0] * 3 for _ in range(bins)], [0] * len(vectors)
    for i in sorted(range(len(vectors)), key=lambda i: -sum(share[i])):
        dots = [sum(w * x * y for w, x, y in zip(WEIGHTS, share[i], r)) for r in left]
        best = max(dots)
        out[i] = next(b for b in range(bins) if dots[b] > best - 1e-12)
        left[out[i]] = [r - x for r, x in zip(left[out[i]], share[i])]
    return out


def loads(vectors, placed, bins):
    sums = np.zeros((bins, 3))
    np.add.at(sums, placed, vectors)
    return sums


def test_packing_is_by_dot_product():
    rng = np.random.default_rng(3)
    vectors = np.stack(
        [rng.integers(1, 9000, 300), rng.integers(1, 1500, 300), np.ones(300, np.int64)], axis=1
    )
    placed = pack_vectors(vectors, 7)
    assert np.allclose(
        loads(vectors, placed, 7), loads(vectors, plain_pack(vectors.tolist(), 7), 7), rtol=0.01
    )


def check(rows, docs, shards):
    assert Counter(r.doc_id for r in rows) == Counter(d[0] for d in docs)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    sizes = Counter((d[0], len((d[1] or "").encode()) + 1, zlib.crc32((d[1] or "").encode()))
                    for d in docs)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == sizes


def test_groups_stay_together_and_sizes_are_near_equal(spark):
    docs = corpus(n=400)
    rows = assign_shards(table(spark, docs).repartition(5), shards=4).collect()
    check(rows, docs, 4)
    text = {d[0]: d[1] for d in docs}
    of = defaultdict(set)
    for r in rows:
        of[text[r.doc_id]].add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    totals = [sum(r.size for r in rows if r.shard == s) for s in range(4)]
    assert max(totals) < 1.02 * min(totals)


@pytest.mark.parametrize("lots", [1, 64, 4096])
def test_a_hot_group_is_cut(spark, lots):
    docs = corpus(n=300) + [(1000 + i, "one text of many copies " * 6, "en", "s", 0)
                            for i in range(300)]
    rows = assign_shards(table(spark, docs), shards=8, lots=lots).collect()
    check(rows, docs, 8)
    assert len({r.shard for r in rows if r.doc_id >= 1000}) > 2
    if lots > 1:
        totals = [sum(r.size for r in rows if r.shard == s) for s in range(8)]
        assert max(totals) < 1.3 * min(totals)


def test_edges(spark):
    check(assign_shards(table(spark, EDGES, clashing=True)).collect(), EDGES, 16)
    empty = assign_shards(table(spark, []))
    assert empty.collect() == []
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} <= {
        *empty.columns
    }


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = corpus(n=100)
    folder = str(tmp_path / "shards")
    write_shards(table(spark, docs), folder, shards=4)
    back = spark.read.parquet(folder)
    planned = assign_shards(table(spark, docs), shards=4)
    assert Counter(map(tuple, back.drop("shard").collect())) == Counter(docs)
    assert Counter(back.select("doc_id", "shard").collect()) == Counter(
        planned.select("doc_id", "shard").collect()
    )
    with pytest.raises(ValueError):
        write_shards(back, folder + "2")
