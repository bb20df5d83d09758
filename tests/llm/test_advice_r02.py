import random

import pytest
from test_llm_text import ITEMS, brute_alignment, reader  # noqa: F401
from texts import WORDS, sentence, table

from conftest import SMALL
from curbside.llm import decontamination, html_text
from curbside.llm.html_blocks import read_page, text_blocks
from curbside.llm.queries import QUERIES
from curbside.llm.tables import read


def texts_of(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    found = html_text.extract_text(df, **options).collect()
    return {r.page_id: r.text for r in found}


def test_an_article_loses_only_whole_repeated_structures(spark):
    """Headings, list entries, cells and notes stay however often they recur."""
    pages = []
    for i in range(12):
        parts = [
            "<h2>References</h2>", f"<ul><li>Yes</li><li>own item {i}</li></ul>",
            f"<p><b>Note</b> of page {i}</p>", "<p>The same words</p>",
            f"<table><tr><td>Total</td><td>cell {i}</td></tr></table>", "<div>Alone</div>",
            "<div><p>Share this</p><ul><li>by mail</li><li>by post</li></ul></div>",
        ]
        pages.append((i, f"http://a.example/{i}", f"<article>{''.join(parts)}</article>"))
    text = texts_of(spark, pages)
    for i in range(12):
        assert text[i].split("\n") == [
            "References", "Yes", f"own item {i}", f"Note of page {i}", "The same words", "Total",
            f"cell {i}", "Alone",
        ]


def test_named_elements_are_counted(spark):
    """What a menu has on four pages and the text of a fifth is a template there."""
    link = "<ul><li><a>Home</a></li></ul>"
    pages = [(i, "http://a.example/", f"<nav>{link}</nav><p>own {i}</p>") for i in range(4)]
    pages.append((4, "http://a.example/", f"<div>{link}</div><p>own 4</p>"))
    assert texts_of(spark, pages) == {i: f"own {i}" for i in range(5)}


def test_block_that_begins_inline_belongs_to_its_paragraph():
    one, other = (read_page(f"<body><div><b>One</b> {w}</div></body>") for w in ("line", "other"))
    assert one.blocks == ["One line"] and len(one.spans) == 1
    assert one.spans[0].hash != other.spans[0].hash


def test_query_parts_blocks_by_two_line_ends(spark):
    pages = {r.page_id: r.html for r in read(spark, SMALL, "pages").collect()}
    found = QUERIES["op2_html_text"](spark, SMALL).collect()
    assert any("\n\n" in r.text for r in found)
    for r in found:
        assert r.text == "\n\n".join(text_blocks(pages[r.page_id]))
        assert r.n_chars == len(r.text)


def test_template_of_one_section_of_a_large_host(spark):
    pages = []
    for i in range(800):
        same = "<div><p>All of our news</p></div>" if i < 120 else ""
        pages.append((i, "http://a.example/", f"<div><p>own {i}</p></div>{same}"))
    assert texts_of(spark, pages) == {i: f"own {i}" for i in range(800)}


def test_pages_of_nothing_but_templates_are_empty(spark):
    menu = "<div><span>Home</span></div><div><span>Contact</span></div>"
    pages = [(i, "http://a.example/", f"{menu}<div><p>own {i}</p></div>") for i in range(10)]
    pages.append((10, "http://a.example/", menu))
    text = texts_of(spark, pages)
    assert text == {i: f"own {i}" for i in range(10)} | {10: ""}


def test_copies_of_a_page_do_not_make_its_text_a_template(spark):
    menu = "<div><span>Home</span></div>"
    pages = [(i, "http://a.example/", f"{menu}<div><p>own {i}</p></div>") for i in range(10)]
    pages += [(i, "http://a.example/", f"{menu}<div><p>copied</p></div>") for i in range(10, 20)]
    text = texts_of(spark, pages)
    assert text == {i: f"own {i}" if i < 10 else "copied" for i in range(20)}


def every(words, k, change):
    return [x for i, w in enumerate(words) for x in (change(w) if i % k == k - 1 else [w])]


def test_densely_edited_items_are_found(spark):
    """As full Smith-Waterman finds them, for edits that leave no run of three words."""
    rng = random.Random(3)
    bench = [(i, sentence(rng, n)) for i, n in enumerate([3, 4, 5, 6, 8, 11, 15, 24, 38, 59])]
    edits = [
        lambda w: every(w, 3, lambda x: ["new"]), lambda w: every(w, 2, lambda x: [x, "new"]),
        lambda w: every(w, 1, lambda x: [x, "new"]), lambda w: every(w, 2, lambda x: ["new"]),
        lambda w: every(w, 3, lambda x: []), lambda w: every(w, 3, lambda x: [x, "new", "two"]),
        lambda w: [x for x in w if rng.random() > 0.3],
        lambda w: [x if rng.random() > 0.35 else "new" for x in w],
    ]
    rows = []
    for _, text in bench:
        for edit in edits:
            around = [f"other{rng.randrange(500)}" for _ in range(400)]
            around[200:200] = edit(text.split())
            rows.append((len(rows), " ".join(around), None, None, 0))
    number = {w: k for k, w in enumerate(WORDS)}
    def coded(text):
        return [number.setdefault(w, len(number)) for w in text.split()]
    want = set()
    for doc, text, *_ in rows:
        line = coded(text)[190:-190]
        for item, words in bench:
            part = coded(words)
            if brute_alignment(part, line) >= 0.8 * len(part):
                want.add((doc, item))
    bench = spark.createDataFrame(bench, ITEMS)
    found = decontamination.contaminated(table(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want


@pytest.mark.parametrize(
    ("shown", "meant"),
    [("iidiioot", "idiot"), ("stuupiid", "stupid"), ("a$$", "ass"), ("dumba$$!", "dumbass"),
     ("idio+", "idiot"), ("idiot$", "idiot")],
)
def test_doubled_and_last_letters_are_read(reader, shown, meant):  # noqa: F811
    assert meant in reader.words(shown)


def test_signs_far_apart_are_joined(reader):  # noqa: F811
    assert "idiot" in reader.spaced("you i  d\ni  o t here")
