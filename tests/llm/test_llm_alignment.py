import hashlib
from collections import Counter

import numpy as np
import pytest
from texts import EDGES, corpus, table

from curbside.llm.alignment import (
    BYTE_LEVEL,
    PIECES,
    ByteLevel,
    Pieces,
    align_tokenizers,
    terminals,
    token_groups,
)

ODD = [
    (100, "<|endoftext|> and <s> </s> <unk> <0x41>", None, None, 0),
    (101, "▁ is a sign, \x00 too", None, None, 0),
    (102, " \n\n  blanks  \t around   ", None, None, 0),
    (103, "é \U0001f468‍\U0001f469‍\U0001f467 ﬁ Ａ", None, None, 0),
    (104, "ab" * 3000, None, None, 0),
    (105, " " * 4000 + "x", None, None, 0),
]


@pytest.fixture(scope="module")
def sides():
    return ByteLevel(open(BYTE_LEVEL, "rb").read()), Pieces(open(PIECES, "rb").read())


def spans(side, text):
    ids, at, out = side.encode([text])[0], 0, []
    for i in ids:
        out.append((i, at, at + len(side.bytes[i])))
        at += len(side.bytes[i])
    joined = b"".join(side.bytes[i] for i in ids)
    return out if joined == (" " + text).encode() else None


def brute(docs, sides):
    """Every pair of tokens, compared; groups cut at common ends."""
    linked, rows = Counter(), []
    for doc_id, text, *_ in docs:
        a, b = (spans(side, text) for side in sides) if text else (None, None)
        if not a or not b:
            rows.append((doc_id, 0, 0, 0, [], ""))
            continue
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] \
            if len(a) < 500 else _merged(a, b)
        linked.update(links)
        ends = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, start = [], 0
        for end in ends:
            inside = [",".join(str(t[0]) for t in side if start < t[2] <= end) for side in (a, b)] \
                if len(a) < 500 else None
            groups.append("|".join(inside) if inside else "")
            start = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(a) < 500 else None
        rows.append((doc_id, len(a), len(b), len(ends), links, sha))
    most = Counter()
    for (_, y), n in linked.items():
        most[y] = max(most[y], n)
    return [
        (d, na, nb, g, len(ls), sum(linked[p] == most[p[1]] for p in ls),
         sum(linked[p] for p in ls), sha)
        for d, na, nb, g, ls, sha in rows
    ]


def _merged(a, b):
    out, j = [], 0
    for x in a:
        while b[j][2] <= x[1]:
            j += 1
        k = j
        while k < len(b) and b[k][1] < x[2]:
            out.append((x[0], b[k][0]))
            k += 1
    return out


def compared(got, want):
    got = sorted((tuple(r) for r in got), key=str)
    want = sorted(want, key=lambda r: str(r[:7]))
    got = sorted(got, key=lambda r: str(r[:7]))
    assert [r[:7] for r in got] == [r[:7] for r in want]
    for g, w in zip(got, want):
        assert w[7] is None or g[7] == w[7]


@pytest.mark.parametrize("known", [1, 40, 1 << 17])
def test_matches_brute_force(spark, sides, known):
    docs = corpus(n=25) + EDGES + ODD
    found = align_tokenizers(
        table(spark, docs, clashing=True).repartition(3), batch_bytes=500, known_pairs=known
    )
    compared(found.collect(), brute(docs, sides))


def test_surrogates_and_empty_tables(spark):
    assert align_tokenizers(table(spark, [])).collect() == []
    assert token_groups(table(spark, [])).collect() == []


def test_terminals_are_group_ends():
    rng = np.random.default_rng(5)
    for _ in range(50):
        total = int(rng.integers(1, 60))
        ends = [
            np.unique(np.append(rng.integers(1, total + 1, rng.integers(0, 30)), total))
            for _ in range(2)
        ]
        common = np.intersect1d(*ends)
        last = terminals(*ends)
        want = common[np.searchsorted(common, np.concatenate(ends))]
        assert np.array_equal(ends[1][last], want)


def test_groups_give_the_text_back(spark, sides):
    docs = [d for d in corpus(n=10) + ODD if d[1]]
    rows = token_groups(table(spark, docs)).collect()
    for doc_id, text, *_ in docs:
        groups = sorted((r for r in rows if r.doc_id == doc_id), key=lambda r: r.nth)
        if not spans(sides[0], text) or not spans(sides[1], text):
            assert not groups
            continue
        raw = (" " + text).encode()
        assert [g.nth for g in groups] == list(range(len(groups)))
        assert groups[0].start == 0 and groups[-1].end == len(raw)
        for g in groups:
            for side, ids in zip(sides, (g.a_ids, g.b_ids)):
                assert b"".join(side.bytes[i] for i in ids) == raw[g.start : g.end]


def test_long_runs(spark):
    docs = [(1, " " * 1_500_000 + "x", None, None, 0), (2, "\n" * 1_000_000, None, None, 0),
            (3, "a" * 1_000_000, None, None, 0)]
    rows = {r.doc_id: r for r in align_tokenizers(table(spark, docs)).collect()}
    assert len(rows) == 3 and rows[3].n_links == rows[3].n_a + rows[3].n_b - rows[3].n_groups
