import hashlib
import random
import re
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from texts import EDGES, corpus, order, table, tokens

from curbside.llm import exact_dedup, golomb, line_dedup, simhash_dedup
from curbside.llm.components import connected_components


@pytest.mark.parametrize("n", [0, 1, 2, 1000])
def test_golomb_round_trip(n):
    values = np.unique(np.random.default_rng(n).integers(0, 2**64 - 1, n, dtype=np.uint64))
    k, q, r = golomb.encode(values)
    assert (golomb.decode(len(values), k, q, r) == values).all()


def test_golomb_saves_space():
    values = np.arange(0, 1_000_000, 97, dtype=np.uint64)
    k, q, r = golomb.encode(values)
    assert len(q) + len(r) < len(values) * 1.5


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def check_exact(rows, found):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    names = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    assert len(found) == len(rows)
    kept = {}
    for r in found:
        text = names[r.text_sha256]
        assert r.doc_id in groups[text]
        assert r.keep_id == min(groups[text], key=order)
        assert r.group_size == len(groups[text])
        assert not r.kept or r.doc_id == r.keep_id
        kept[text] = kept.get(text, 0) + r.kept
    assert set(kept.values()) == {1}


@pytest.mark.parametrize("rows", [corpus(), EDGES], ids=["corpus", "edges"])
@pytest.mark.parametrize("sizes", [(1 << 20, 1 << 20), (10, 7)])
def test_exact_duplicates(spark, rows, sizes):
    docs = table(spark, rows, clashing=True)
    found = exact_dedup.exact_duplicates(docs, owner_hashes=sizes[0], block_rows=sizes[1])
    check_exact(rows, found.collect())
    stay = exact_dedup.drop_exact_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted(normal(r.text) for r in stay.collect()) == sorted({normal(r[1]) for r in rows})


def test_texts_of_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("00" * 32))
    rows = [(1, "a", None, None, 0), (2, "b", None, None, 0), (3, "a", None, None, 0)]
    found = exact_dedup.exact_duplicates(table(spark, rows)).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in found} == {
        (1, 1, 2, True), (2, 2, 1, True), (3, 1, 2, False),
    }


def test_empty_tables(spark):
    none = table(spark, [])
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.drop_exact_duplicates(none).count() == 0
    assert simhash_dedup.near_duplicates(none).count() == 0
    assert simhash_dedup.drop_near_duplicates(none).count() == 0
    assert line_dedup.repeated_lines(none).count() == 0


def simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    prints = [simhash(r[1]) for r in rows]
    label = [r[0] for r in rows]
    while True:
        new = [
            min((b for p, b in zip(prints, label) if (p ^ q).bit_count() <= 2), key=order)
            for q in prints
        ]
        if new == label:
            return prints, label
        label = new


@pytest.mark.parametrize("rows", [corpus(2), EDGES], ids=["corpus", "edges"])
def test_near_duplicates(spark, rows):
    docs = table(spark, rows, clashing=True)
    prints, label = components(rows)
    expected = sorted(
        ((r[0], f"{p:016x}", c) for r, p, c in zip(rows, prints, label)), key=str
    )
    found = simhash_dedup.near_duplicates(docs).collect()
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found), key=str)
    assert got == expected
    stay = simhash_dedup.drop_near_duplicates(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id for r in stay.collect()), key=order) == sorted(set(label), key=order)


def test_crowded_anchors_lose_no_link(spark):
    rng = np.random.default_rng(3)
    center = int(rng.integers(0, 2**63))
    fps = {center}
    while len(fps) < 400:
        x = center
        for b in rng.choice(64, 3, replace=False):
            x ^= 1 << int(b)
        fps.add(x)
    fps |= {int(x) for x in rng.integers(0, 2**63, 50)}
    signed = sorted(int(np.array(x, np.uint64).view(np.int64)) for x in fps)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    values = np.array(signed).view(np.uint64)
    close = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    label = np.arange(len(values))
    while True:
        new = np.array([label[c].min() for c in close])
        if (new == label).all():
            break
        label = new
    expected = {frozenset(np.flatnonzero(label == x)) for x in set(label)}
    for pair_rows, block in ((10_000, 10_000), (2, 10_000), (2, 20)):
        links = simhash_dedup.fingerprint_links(df, 2, pair_rows, block)
        roots = {r.node: r.root for r in connected_components(links).collect()}
        groups = {}
        for i, x in enumerate(signed):
            groups.setdefault(roots.get(x, x), set()).add(i)
        assert {frozenset(g) for g in groups.values()} == expected


def test_anchors_are_never_broadcast(spark, conf, monkeypatch):
    """Spark takes 32 anchors of a fingerprint for one row and finds them small."""
    conf("spark.sql.autoBroadcastJoinThreshold", "10MB")
    plans, stored = [], simhash_dedup.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(simhash_dedup, "stored", noted)
    links = simhash_dedup.fingerprint_links(spark.range(500).select(F.xxhash64("id").alias("fp")))
    links.collect()
    plans.append(links._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2
    assert all("SortMergeJoin" in p and "BroadcastExchange" not in p for p in plans)


def test_components_of_a_long_chain(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = connected_components(edges).collect()
    assert {r.root for r in found} == {0} and len(found) == 301


def check_lines(rows, found, least=0.8):
    """Every line against all others, by its set of words."""
    lines = []
    for doc_id, text, *_ in rows:
        for k, line in enumerate((text or "").split("\n")):
            words = tuple(tokens(line.lower()))
            if words:
                lines.append((order(doc_id), k, words, frozenset(words), doc_id))
    lines.sort(key=lambda x: x[:2])
    texts = {words: mine for _, _, words, mine, _ in lines}

    def similar(a, b):
        return len(a & b) >= least * len(a | b)

    want = []
    for i, (_, k, words, mine, doc_id) in enumerate(lines):
        match = next(((d, n) for _, n, _, s, d in lines[:i] if similar(mine, s)), (None, None))
        kept = not any(similar(mine, s) for _, _, _, s, _ in lines[:i])
        links = sum(w != words and similar(mine, s) for w, s in texts.items())
        copies = sum(w == words for _, _, w, _, _ in lines)
        want.append((doc_id, k, kept, *match, copies, links))
    got = [
        (r.doc_id, r.line_no, r.kept, r.match_id, r.match_line, r.n_lines, r.n_links)
        for r in found
    ]
    assert sorted(got, key=str) == sorted(want, key=str)
    return want


def long_lines():
    rows = []
    for doc_id, text, *rest in corpus(5, 20):
        rows.append((doc_id, text.replace("\n", " "), *rest))
    base = " ".join(f"w{i}" for i in range(60))
    for i in range(40):
        rows.append((100 + i, base.replace(f"w{30 + i % 3}", f"edit{i}"), None, None, 0))
    return rows


def edited_lines():
    """Lines of all sizes, each with copies that have one word changed or one more."""
    rng, rows = random.Random(8), []
    for size in range(1, 49):
        words = [f"x{size}y{i}" for i in range(size)]
        for n in range(3):
            changed = list(words)
            changed[rng.randrange(size)] = f"new{size}z{n}"
            rows.append((len(rows), " ".join(changed), None, None, 0))
        rows.append((len(rows), " ".join(words), None, None, 0))
        rows.append((len(rows), " ".join([*reversed(words), f"more{size}"]), None, None, 0))
    return rows


def chained_lines():
    """Groups within reach of several leaders, as 164 one-line documents."""
    rng, rows = random.Random(9), []
    base = [f"a{i}" for i in range(20)]
    for i in range(164):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(20)] = f"b{rng.randrange(30)}"
        rows.append((i, " ".join(words), None, None, 0))
    return rows


@pytest.mark.parametrize("crowd", [2, 64, 100_000])
@pytest.mark.parametrize(
    "rows", [corpus(4), long_lines(), chained_lines()], ids=["corpus", "near copies", "chains"]
)
def test_repeated_lines(spark, rows, crowd):
    docs = table(spark, rows, clashing=True)
    want = check_lines(rows, line_dedup.repeated_lines(docs, crowd=crowd).collect())
    assert any(w[6] for w in want)


def test_one_changed_word(spark):
    rows = edited_lines()
    want = check_lines(rows, line_dedup.repeated_lines(table(spark, rows)).collect())
    # From 9 words on a changed word leaves a similarity of 0.8, and so does one more from 4.
    assert sum(w[6] > 0 for w in want) > 200


def test_other_similarities(spark):
    rows = chained_lines()[:60] + edited_lines()[:60]
    for least in (0.5, 0.95):
        found = line_dedup.repeated_lines(table(spark, rows), jaccard=least).collect()
        check_lines(rows, found, least)


def test_repeated_lines_of_odd_rows(spark):
    rows = [r for r in EDGES if r[0] != 1] + EDGES[:2]
    check_lines(rows, line_dedup.repeated_lines(table(spark, rows, True)).collect())


def test_long_lines_that_differ_are_no_candidates(spark):
    """Lines of 100 of 400 words share rare words, and only near copies are compared."""
    rng, rows = random.Random(10), []
    for i in range(120):
        words = rng.sample([f"v{k}" for k in range(400)], 100)
        rows.append((2 * i, " ".join(words), None, None, 0))
        if i % 10 == 0:
            rows.append((2 * i + 1, " ".join(["other", *words[1:]]), None, None, 0))
    docs = table(spark, rows)
    _, sets = line_dedup._sets(docs, "doc_id", "text", 0.8)
    assert line_dedup._candidates(sets, 0.8, line_dedup.CROWD).count() < 24
    want = check_lines(rows, line_dedup.repeated_lines(docs).collect())
    assert sum(w[6] for w in want) == 24


def test_lines_about_the_size_of_more_parities(spark):
    rng, rows = random.Random(11), []
    for i in range(60):
        size = line_dedup.MANY_WORDS - 3 + i % 7
        words = [f"p{i // 6}q{k}" for k in range(size)]
        for _ in range(rng.randrange(6)):
            words[rng.randrange(size)] = f"r{rng.randrange(50)}"
        rows.append((i, "  " * (i % 2) + " ".join(words), None, None, 0))
    want = check_lines(rows, line_dedup.repeated_lines(table(spark, rows)).collect())
    assert sum(w[6] > 0 for w in want) > 30


def test_shuffle_files_go_with_their_job(spark):
    def files():
        folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {p for d in folders.localDirsString() for p in Path(d).rglob("shuffle_*")}

    before, was = files(), spark.conf.get(line_dedup.CLEANUP)
    _, sets = line_dedup._sets(table(spark, corpus(4)), "doc_id", "text", 0.8)
    own = {p for p in files() - before if p.suffix == ".data"}
    # What the one array of word classes takes is all that is left.
    assert len({p.name.split("_")[1] for p in own}) <= 2
    assert spark.conf.get(line_dedup.CLEANUP) == was
    assert sets.count() > 0


def test_line_dedup_runs_no_python(spark):
    plan = line_dedup.repeated_lines(table(spark, corpus(4)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", text)
