import hashlib
import io
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import EDGES, LONG, corpus, left, sentence, table, tokens

from curbside.llm import (
    charmodel,
    decontamination,
    html_text,
    language_id,
    mixing,
    token_files,
    toxicity,
    warc,
    wordhash,
)
from curbside.llm.html_blocks import text_blocks
from curbside.scratch import scratch_folder

ITEMS = "item_id long, text string"


def items(rng):
    return [(i, sentence(rng, 30 + i)) for i in range(6)]


def leaky(rng, bench):
    """Documents and which items they hold: whole, edited, cut or not at all."""
    rows, want = [], set()
    for i in range(60):
        words = sentence(rng, 80).split()
        if i % 3 == 0:
            item, text = bench[i % len(bench)]
            copy = text.split()
            if i % 2:
                for k in range(3, len(copy), 7):
                    copy[k] = "edited"
                del copy[10]
            words[20:20] = copy
            want.add((i, item))
        rows.append((i, " ".join(words).upper() if i % 4 == 0 else ", ".join(words), None, None, 0))
    return rows, want


def test_leaks_are_found_and_others_left_alone(spark):
    rng = random.Random(7)
    # Words of their own keep chance likeness out of the truth.
    bench = [(i, re.sub(r"(\w+)", r"q\1", t)) for i, t in items(rng)]
    rows, want = leaky(rng, bench)
    docs, bench = table(spark, rows, True), spark.createDataFrame(bench, ITEMS)
    found = decontamination.contaminated(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all((r.score == 1) == (r.doc_id % 2 == 0) for r in found)
    clean = decontamination.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r[0] for r in rows} - {d for d, _ in want}


def test_decontamination_of_odd_rows(spark):
    docs = table(spark, EDGES, True)
    bench = spark.createDataFrame(
        [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"),
         (2, None), (3, ""), (4, "too short"), (None, " ".join(LONG.split()[:3000])), (5, "!?")],
        ITEMS,
    )
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()}
    assert found == {(1, 1), (None, 1), (5, None)}
    kept = decontamination.drop_contaminated(docs, bench).collect()
    assert len(kept) == len(EDGES) - 4
    assert "something else entirely under the same id" in {r.text for r in kept}
    assert decontamination.contaminated(docs, bench.limit(0)).count() == 0
    assert decontamination.contaminated(docs.limit(0), bench).count() == 0


def brute_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            same = 2 if a[i - 1] == b[j - 1] else -1
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] - 1, h[i, j - 1] - 1)
    return h.max()


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(5)
    lines = [rng.integers(0, 6, rng.integers(1, 30)) for _ in range(40)]
    parts = [rng.integers(0, 6, rng.integers(1, 20)) for _ in range(40)]
    score, _ = decontamination.smith_waterman(lines, parts)
    assert score.tolist() == [brute_alignment(b, a) for a, b in zip(lines, parts)]


def test_word_hashes_tell_words_apart():
    words = wordhash.word_hashes("The cat, THE CAT; the-cat é")
    assert len(words) == 7 and words[0] == words[2] == words[4] != words[1] == words[3]
    assert len(wordhash.word_hashes(None)) == len(wordhash.word_hashes(" .,")) == 0
    assert len(wordhash.word_hashes(LONG)) == 40_000


PAGE = """<html><head><title>no</title><script>var a="<p>";</script></head>
<body class="no-sidebar"><nav><a href=x>menu</a></nav><div class="ad">buy</div>
<article><h1>Head &amp; tail</h1><p><b>One
 line<br>more<p>two &lt;b&gt;</article>
<div id="comments">me too</div><footer>f</footer></body></html>"""


def test_article_blocks():
    assert text_blocks(PAGE) == ["Head & tail", "One line more", "two <b>"]
    for empty in (None, "", "   ", "<p></p>", "<!-- x", "<script>a"):
        assert text_blocks(empty) == []


def test_templates_go_and_prose_stays(spark):
    pages = []
    for i in range(12):
        body = f"<div><p>own {i} text</p></div><div class=x><span>Follow us all</span></div>"
        pages.append((i, f"http://a.example/{i}", f"<body>{body}</body>"))
    for i in range(12, 20):
        same = "<p>the line that every article has</p>"
        pages.append((i, "https://B.example:80/", f"<article>{same}<p>p{i}</p></article>"))
    pages += [(20, None, None), (21, "no host", ""), (None, None, "<p>x"), (22, "http://c.example", LONG)]
    pages += [(30 + i, "http://d.example/", "<div><p>all the same page</p></div>") for i in range(9)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df = df.select("*", F.lit(1).alias("text"), F.lit(2).alias("row"), F.lit(3).alias("blocks"))
    got = {(r.page_id, r.url): r for r in html_text.extract_text(df).collect()}
    assert len(got) == len(pages)
    text = {k[0]: r.text for k, r in got.items()}
    assert all(text[i] == f"own {i} text" for i in range(12))
    assert all(text[i] == f"the line that every article has\np{i}" for i in range(12, 20))
    assert (text[20], text[21], text[None], text[22]) == ("", "", "x", LONG)
    assert all(text[30 + i] == "all the same page" for i in range(9))
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1 << 20, 64, 7])
def test_token_counts(spark, block):
    with open(token_files.TOKENIZER, "rb") as ranks:
        encoder = token_files._encoder(ranks.read())
    rows = corpus(3, 20) + [r for r in EDGES if r[0] != 5]
    found = token_files.count_tokens(table(spark, rows, True), block_tokens=block).collect()
    want = [(r[0], len(encoder.encode_ordinary(r[1] or ""))) for r in rows]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_tokens)) for r in found)
    assert token_files.count_tokens(table(spark, [])).count() == 0


def test_scan_of_files_without_a_ledger(spark):
    folder = scratch_folder(spark, "tokens")
    token_files.files.make_folder(folder)
    end = token_files.END
    for name, ids, extra in (("a", [1, 2, end, end, 3], b"\x07"), ("b", [], b""), ("c", [end], b"")):
        with token_files.files.open_write(f"{folder}/{name}.bin") as out:
            out.write(np.array(ids, "<u2").tobytes() + extra)
    found = token_files.scan_token_files(spark, folder, block_tokens=2).collect()
    assert sorted((r.file[0], r.nth, r.start, r.n_tokens, r.closed) for r in found) == [
        ("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 1, False), ("c", 0, 0, 0, True),
    ]


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 900
    rows = [(1, "http://a/ b\r\n", big), (5, None, big), (3, "u", big), (2, "u", "small"),
            (4, "u", "small"), (6, "u", None), (7, "u", ""), (9, "u", LONG), (9, "u", LONG),
            (8, "u", LONG), (None, "u", big), (None, "u", None), (10, "u", "a\r\n\r\nb")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.select("*", F.lit(1).alias("first"), F.lit(2).alias("sha"), F.lit(3).alias("file"))
    found = warc.round_trip(df, archive_bytes=3000).collect()
    want = []
    for page_id, _, html in rows:
        raw = (html or "").encode()
        first = max((p for p, _, h in rows if h == html and p is not None), default=None)
        again = len(raw) >= 1000 and first is not None and page_id != first
        want.append((page_id, len(raw), hashlib.sha1(raw).hexdigest(),
                     "revisit" if again else "response", first if again else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert warc.round_trip(df.limit(0)).count() == 0


def test_records_of_any_gzip_stream():
    records = [warc.build_record(i, "u", b"x" * 10 * i) for i in range(300)]
    def gz(x):
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        return pack.compress(x) + pack.flush()
    whole, members = gz(b"".join(records)), b"".join(map(gz, records))
    for stream in (whole, members):
        found = list(warc.split_records(warc.inflated(io.BytesIO(stream))))
        assert [raw for _, raw in found] == records
    with pytest.raises(ValueError):
        list(warc.split_records(warc.inflated(io.BytesIO(gz(b"".join(records)[:-9])))))


@pytest.fixture(scope="module")
def reader(spark):
    rows = corpus(8) + [(500 + i, "the idiot met a stupid clown and a loser", "en", "a", 1) for i in range(20)]
    return charmodel.Decoder(charmodel.train(table(spark, rows)))


@pytest.mark.parametrize("shown", ["idiot", "1d10t", "id!ot", "iiiidiiiot", "i.d.i.o.t", "idiot###", "!d!0t!!"])
def test_disguised_words_are_read(reader, shown):
    assert reader.words(shown) == ("idiot",)


def test_plain_words_and_signs_stay(reader):
    assert reader.words("karen") == ("karen",)
    assert reader.words("2024") == reader.words("---") == ()
    assert "idiot" in reader.spaced("you i d i o t here")
    assert reader.spaced("a a a a a a") == []


def toxic_corpus():
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        words = sentence(rng, 25).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(25), rng.choice(["idiot", "1d10t", "scum", "sc.um"]))
        rows.append((i, " ".join(words), "en", "s", 1))
        labels.append((i, int(bad)))
    return rows, labels


def test_toxicity_on_held_out_texts(spark):
    rows, labels = toxic_corpus()
    rows += EDGES[3:]
    docs = table(spark, rows, True)
    labels = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.score_toxicity(docs, labels).collect()
    assert len(found) == len(rows)
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and left(r.doc_id, 5) == 0)
    good = [r.predicted == (r.doc_id % 5 == 0) for r in found if r.held_out and 9 < r.doc_id < 900]
    assert np.mean(good) > 0.97
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(not r.predicted for r in found)


@pytest.mark.parametrize("labels", [[], [(1, 0), (2, 0)], [(1, 1)], [(None, None)]])
def test_toxicity_without_two_kinds_of_labels(spark, labels):
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    scores = toxicity.score_toxicity(table(spark, EDGES), labels).collect()
    assert len(scores) == len(EDGES) and len({r.score for r in scores}) == 1
    assert toxicity.score_toxicity(table(spark, []), labels).count() == 0


def brute_mix(rows):
    sizes = [len(tokens(r[1])) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total = {s: sum(n for n, r in zip(sizes, rows) if r[3] == s) for s in names}
    target, left_over, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes), set(names)
    while left_over > 1e-9 and open_:
        share = left_over / sum(weight[s] for s in open_)
        left_over = 0.0
        for s in sorted(open_, key=str):
            target[s] += share * weight[s]
            if target[s] >= 2 * total[s]:
                left_over += target[s] - 2 * total[s]
                target[s] = 2.0 * total[s]
                open_.discard(s)
    return sizes, total, target


@pytest.mark.parametrize("rows", [corpus(6, 200), EDGES[3:-1]], ids=["corpus", "edges"])
@pytest.mark.parametrize("range_rows", [1 << 12, 5])
def test_mix_meets_its_targets(spark, rows, range_rows):
    docs = table(spark, rows, True)
    found = mixing.mix_sources(docs, range_rows=range_rows).collect()
    sizes, total, target = brute_mix(rows)
    source = {r[0]: r[3] for r in rows}
    assert len(found) == len(rows)
    taken = dict.fromkeys(target, 0)
    for r in found:
        s = source[r.doc_id]
        assert r.source_size == total[s] and r.target == pytest.approx(target[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    largest = max(sizes)
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in target)
    again = mixing.mix_sources(docs.repartition(3), range_rows=1 << 16).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))
    assert mixing.mix_sources(table(spark, [])).count() == 0


def test_copies_on_offer_are_never_broadcast(spark, conf, monkeypatch):
    """Spark takes the copies that an explode makes for few and finds them small."""
    conf("spark.sql.autoBroadcastJoinThreshold", "10MB")
    plans, stored = [], mixing.stored

    def noted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(mixing, "stored", noted)
    docs = spark.range(300).selectExpr(
        "id AS doc_id", "repeat('word ', 20) AS text", "string(id % 3) AS source"
    )
    queue = mixing.fair_queue(docs)
    assert queue.count() == 600
    plans.append(queue._jdf.queryExecution().executedPlan().toString())
    joins = [line for p in plans for line in p.splitlines() if "HashJoin" in line and "epoch" in line]
    joins += [line for line in plans[-1].splitlines() if "HashJoin" in line]
    assert not any("BuildLeft" in line for line in joins)


def test_source_is_cut_where_its_target_is(spark):
    rows = [(i, sentence(random.Random(i), 10), f"x{i % 2}", f"x{i % 2}", 0) for i in range(400)]
    found = mixing.mix_sources(table(spark, rows)).collect()
    for name in (0, 1):
        mine = [r for r in found if r.doc_id % 2 == name]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 20


def test_languages_and_mixtures(spark):
    rng = random.Random(2)
    fr = ["le", "chat", "mange", "une", "souris", "dans", "la", "maison", "avec", "joie"]
    de = ["der", "hund", "läuft", "über", "die", "straße", "und", "schläft", "nicht", "mehr"]
    def text(words, n):
        return " ".join(rng.choice(words) for _ in range(n))
    rows = [(i, text(fr if i % 2 else de, 40), "fr" if i % 2 else "de", None, 0) for i in range(200)]
    rows.append((900, text(fr, 150) + " " + text(de, 75), None, None, 0))
    odd = [(901, None, None, None, 0), (902, "", "fr", None, 0), (903, "12 -- !", "xx", None, 0),
           (904, "é", None, None, 0), (None, text(de, 10), "de", None, 0), (905, LONG, None, None, 0)]
    docs = table(spark, rows + odd, True)
    held = toxicity.held_out("doc_id", 4, 2)
    found = {r.doc_id: r for r in language_id.identify_languages(docs, docs.where(~held)).collect()}
    assert len(found) == len(rows) + len(odd)
    test = [i for i in range(200) if left(i, 4) == 2]
    assert all(found[i].lang_pred == ("fr" if i % 2 else "de") for i in test)
    assert all(found[i].languages == found[i].lang_pred for i in test)
    assert found[900].languages == "fr,de" and found[900].score == pytest.approx(0.63, abs=0.1)
    assert [found[i].lang_pred for i in (901, 902, 903)] == ["und"] * 3
    assert found[None].lang_pred == "de" and found[904].lang_pred in ("fr", "de", "xx")
    assert all(0 <= r.score <= 1 for r in found.values())
    none = language_id.identify_languages(docs, docs.limit(0))
    assert {(r.lang_pred, r.score) for r in none.collect()} == {("und", 0.0)}
    assert language_id.identify_languages(docs.limit(0), docs).count() == 0
