"""Main text against a plain parser, hostile pages, and counting alone."""

import random
import time
from collections import Counter, defaultdict
from html.parser import HTMLParser

import pytest

from conftest import SMALL
from curbside.llm.html_blocks import BLOCK, STRUCTURE, VOID, read_page, text_blocks
from curbside.llm.html_text import extract_text
from curbside.llm.tables import read


def texts_of(spark, pages, **options):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.page_id: r.text for r in extract_text(df, **options).collect()}


class Tree(HTMLParser):
    """Well-formed markup as a tree of (tag, children)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [("", [])]

    def handle_starttag(self, tag, attrs):
        node = (tag, [])
        self.stack[-1][1].append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_endtag(self, tag):
        assert self.stack.pop()[0] == tag

    def handle_data(self, data):
        self.stack[-1][1].append(data)


def tree(html):
    parser = Tree()
    parser.feed(html)
    parser.close()
    return parser.stack[0]


def flat(node):
    """Blocks below a node, each with the structures that hold it."""
    out, text = [], []

    def end():
        joined = " ".join("".join(text).split())
        if joined:
            out.append(joined)
        text.clear()

    def walk(node):
        for child in node[1]:
            if isinstance(child, str):
                text.append(child)
            else:
                if child[0] in BLOCK:
                    end()
                walk(child)
                if child[0] in BLOCK:
                    end()

    walk(node)
    end()
    return out


def brute(pages, least=5, share=0.2):
    """Every structure of every page, compared as a whole; for pages without names."""
    whole = [tree(h) for _, _, h in pages]
    seen = defaultdict(set)

    def may_recur(node, prose, beside):
        if node[0] in ("body", "article") or "'article'" in str(node):
            return False
        if prose or not beside:
            return node[0] in STRUCTURE and len(flat(node)) > (1 if prose else 0)
        return node[0] in BLOCK and len(flat(node)) > 0

    def structures(node, prose, beside):
        for child in node[1]:
            if not isinstance(child, str):
                if may_recur(child, prose, beside):
                    yield child
                yield from structures(child, prose or child[0] == "article", beside)

    for page in whole:
        for node in structures(page, False, "'article'" in str(page)):
            seen[str(node)].add(str(flat(page)))
    distinct = len({str(flat(p)) for p in whole})
    templates = {k for k, v in seen.items() if len(v) >= least and len(v) >= share * distinct}

    def without(node, prose, beside):
        kept = []
        for child in node[1]:
            if isinstance(child, str):
                kept.append(child)
            elif may_recur(child, prose, beside) and str(child) in templates:
                kept.append(("div", []))
            else:
                kept.append(without(child, prose or child[0] == "article", beside))
        return (node[0], kept)

    return {
        p[0]: "\n".join(flat(without(t, False, "'article'" in str(t))))
        for p, t in zip(pages, whole)
    }


def site(seed):
    rng = random.Random(seed)

    def words(n):
        return " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"]) for _ in range(n))

    menu = "<div><ul><li>Home</li><li><b>News</b></li></ul></div>"
    advert = "<section><p>Buy now</p></section>"
    share = "<div><p>Share</p><p>Print</p></div>"
    pages = []
    for i in range(30):
        body = "".join(f"<p>{words(6)} {i}</p>" for _ in range(rng.randrange(1, 4)))
        body += rng.choice(["", "<h2>References</h2>", share, "<div>Alone</div>"])
        body += f"<table><tr><td>Total</td><td>{rng.randrange(3)}</td></tr></table>"
        if i % 2:
            body = f"<div><article>{body}</article></div>"
        rest = f"{rng.choice([menu, ''])}{body}{rng.choice([advert, '', '<ul><li>x</li></ul>'])}"
        pages.append((i, "http://a.example/", f"<body>{rest}</body>"))
    return pages


@pytest.mark.parametrize("seed", range(3))
def test_counts_alone_equal_comparing_whole_structures(spark, seed):
    pages = site(seed)
    assert texts_of(spark, pages, check_names=False) == brute(pages)


def test_what_holds_the_article_is_never_dropped():
    page = "<form id=aspnetForm><div class=menu><ul><li>x</li></ul></div><article><p>A</p></article></form>"
    assert text_blocks(page) == ["A"]
    assert text_blocks("<aside class='sidebar'><main><p>A</p></main></aside>") == ["A"]


def test_names_are_whole_names():
    page = """<article><section id="related-work"><p>A</p></section>
      <p class="social-history">B</p><p class="adage">C</p><div class="note form-factor"><p>D</p></div>
      <div class="ad-banner"><p>x</p></div><div id="comment-list"><p>x</p></div>
      <div class="big site-footer"><p>x</p></div><div class="nav-bar"><p>x</p></div></article>"""
    assert text_blocks(page) == ["A", "B", "C", "D"]


def test_title_and_lead_before_the_article():
    page = """<main><nav><p>x</p></nav><h1>Title</h1><p>lead</p><div>other</div>
      <article><p>A</p></article><p>after</p></main><p>out</p>"""
    assert text_blocks(page) == ["Title", "lead", "A"]


@pytest.mark.parametrize(
    "page",
    [
        "<div>x" * 100_000,
        "<b>x" * 100_000,
        "<blockquote><p>x" * 50_000,
        "<article>" + "<section>x" * 100_000,
        '<a "' * 250_000,
        '<a "' * 250_000 + ">",
        '<a b="' * 150_000,
        "<a b='" * 150_000 + ">x",
        "<" * 1_000_000,
        "<!--" * 250_000,
        "<a " + "class=x " * 120_000 + ">y",
        "<li>x" * 100_000,
        "<td>x<tr>" * 60_000,
        "</b>" * 200_000,
        "&amp" * 250_000,
        "<title>" * 100_000,
    ],
    ids=range(16),
)
def test_hostile_pages_take_seconds(page):
    start = time.perf_counter()
    found = read_page(page)
    assert time.perf_counter() - start < 15
    assert len(found.blocks) == len(found.named)


def test_names_and_counts_agree_on_the_given_pages(spark):
    """How much of what names take out recurs often enough to be counted out."""
    rows = read(spark, SMALL, "pages").collect()
    named = {r.page_id: read_page(r.html) for r in rows}
    counted = extract_text(read(spark, SMALL, "pages"), check_names=False, between="\n\n")
    for r in counted.collect():
        page = named[r.page_id]
        own = Counter(b for b, out in zip(page.blocks, page.named) if not out)
        # Counting takes nothing of an article.
        assert not own - Counter(r.text.split("\n\n"))
