"""Text blocks of one page, and the elements that hold them.

A page is read once, from its first sign to its last. Elements and blocks are
lists in page order, so that what an element holds is a range of blocks, and
neither depth nor broken markup makes a page cost more than its length.
"""

from __future__ import annotations

import html
import re
from typing import NamedTuple

import xxhash

# A quote belongs to a value only after "="; one that is never closed is a sign like any other.
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(
    r"(?<![\w-])(class|id|role|hidden)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?+"
    r"(?=[\s/]|$)",
    re.IGNORECASE,
)
_PART = re.compile(r"[a-z]+")

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements whose content is not markup.
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt"
    " fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li"
    " main menu nav ol option p pre search section summary table tbody td tfoot th thead"
    " title tr ul".split()
)
# What opens one of these closes the element of the same kind before it.
_SIBLINGS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "tbody": {"thead", "tbody", "tr", "td", "th"},
    "tfoot": {"thead", "tbody", "tr", "td", "th"},
}
_SCOPE = frozenset("ul ol dl table select article section div body html".split())

# Never part of the text.
DROPPED = RAW | frozenset(
    "head nav footer aside form button select svg canvas object template dialog menu"
    " audio video datalist search".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu"
    " menubar form".split()
)
# Names of classes and ids for what is beside the text. A name of several parts
# counts if one part is among these and the others are, or say nothing.
_NOTHING = frozenset(
    "area banner bar block bottom box container content global group inner item items left"
    " link links list main outer page panel post posts primary right secondary section side"
    " site slot strip thread top unit wrap wrapper".split()
)
_BESIDE = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar"
    " widget widgets ad ads adv advert adverts advertisement advertising sponsor sponsored"
    " promo promoted cookie cookies consent gdpr notice notices notification popup modal"
    " overlay newsletter subscribe subscription signup login social share sharing related"
    " recommended recommendations trending comment comments commentlist disqus respond"
    " reply replies pagination pager toolbar".split()
)
_TEXT_ROOTS = ("article", "main", "body")
_BIT = {root: 1 << i for i, root in enumerate(_TEXT_ROOTS)}
_LEAD = frozenset("h1 h2 h3 h4 h5 h6 p".split())

# Elements that may be a template by themselves. A heading, paragraph, list entry or
# cell is none: alone it may recur as text does.
STRUCTURE = frozenset(
    "address aside center details dialog dir div dl fieldset figure footer form header"
    " hgroup menu nav ol search section table ul".split()
)


class Span(NamedTuple):
    """An element that may recur: the hash of its subtree, and its blocks."""

    hash: int
    first: int
    end: int


class Page(NamedTuple):
    """Blocks in page order; ``named`` tells which of them a name puts beside the text."""

    blocks: list[str]
    named: list[bool]
    spans: list[Span]


class _Element:
    __slots__ = (
        "tag", "parent", "pieces", "hash", "beside", "root", "roots", "open", "holds",
        "first", "end", "out",
    )

    def __init__(self, tag: str, parent: "_Element | None") -> None:
        self.tag, self.parent = tag, parent
        self.pieces: list[str] = []
        self.hash = 0
        self.beside = self.holds = self.out = False
        self.root = ""
        # The roots that it is in, as bits.
        self.roots = parent.roots if parent else 0
        self.open = True
        self.first, self.end = -1, -1


def _names_beside(value: str) -> bool:
    """Whether a class or id is the name of something beside the text."""
    for name in value.split():
        parts = set(_PART.findall(name))
        if parts & _BESIDE and parts <= _BESIDE | _NOTHING:
            return True
        if "".join(_PART.findall(name)) in _BESIDE:
            return True
    return False


def _judge(element: _Element, attributes: str) -> None:
    """Whether an element is beside the text, by its tag, role, class and id."""
    tag = element.tag
    beside = named = header = False
    for name, *values in _ATTRIBUTE.findall(attributes) if attributes.strip() else ():
        value, name = "".join(values).lower(), name.lower()
        if name == "hidden":
            beside = True
        elif name == "role":
            if value == "main":
                element.root = "main"
            beside |= bool(_ROLES & set(value.split()))
        else:
            named |= _names_beside(value)
            header |= "header" in value.split()
    if tag not in ("html", "body", "main"):
        element.beside = beside or named or tag in DROPPED
    # A header within an article is the article's own.
    if tag == "header" or header and tag in ("div", "section"):
        element.beside |= not element.roots & _BIT["article"]
    if tag in _TEXT_ROOTS:
        element.root = tag
    if element.root:
        element.roots |= _BIT[element.root]


class _Builder:
    """Elements and blocks in page order."""

    def __init__(self) -> None:
        self.top = _Element("", None)
        self.at = self.top
        self.elements: list[_Element] = []
        self.blocks: list[tuple[str, _Element]] = []
        self.text: list[str] = []
        self.owner: _Element | None = None
        # How many elements of a tag are open.
        self.opened: dict[str, int] = {}

    def add(self, raw: str) -> None:
        raw = html.unescape(raw)
        self.text.append(raw)
        # Every run of white space becomes one space.
        piece = " ".join(raw.split())
        if piece:
            self.at.pieces.append(piece)
            # The innermost element that holds what came before and this.
            if self.owner is None:
                self.owner = self.at
            while not self.owner.open:
                self.owner = self.owner.parent

    def cut(self) -> None:
        """End the block at hand."""
        if self.text:
            text = " ".join("".join(self.text).split())
            self.text = []
            if text:
                self.blocks.append((text, self.owner))
            self.owner = None

    def close(self) -> None:
        """Close the innermost element."""
        element = self.at
        if element.tag in BLOCK:
            self.cut()
        shape = f"<{element.tag}>" + "\x00".join(element.pieces)
        element.hash = xxhash.xxh64_intdigest(shape.encode("utf-8", "surrogatepass"))
        element.pieces = []
        element.open = False
        self.opened[element.tag] -= 1
        self.at = element.parent
        self.at.pieces.append(str(element.hash))

    def close_to(self, element: _Element) -> None:
        while self.at is not element:
            self.close()
        self.close()

    def find(self, tags, stop) -> _Element | None:
        """The innermost open element of ``tags``, not beyond ``stop``."""
        if not any(self.opened.get(tag) for tag in tags):
            return None
        element = self.at
        while element is not self.top:
            if element.tag in tags:
                return element
            if element.tag in stop:
                return None
            element = element.parent
        return None

    def open(self, tag: str, attributes: str) -> None:
        if tag in BLOCK:
            self.cut()
            paragraph = self.find(("p",), _SCOPE)
            if paragraph is not None:
                self.close_to(paragraph)
            if tag in _SIBLINGS:
                # The outermost of the open siblings, within the same list.
                while (sibling := self.find(_SIBLINGS[tag], _SCOPE)) is not None:
                    self.close_to(sibling)
        element = _Element(tag, self.at)
        _judge(element, attributes)
        self.elements.append(element)
        self.opened[tag] = self.opened.get(tag, 0) + 1
        self.at = element
        if element.root and element.root != "body":
            above = element.parent
            while above is not None and not above.holds:
                above.holds = True
                above = above.parent

    def end(self, tag: str) -> None:
        # An inline end tag does not reach beyond the block it is in.
        element = self.find((tag,), () if tag in BLOCK else BLOCK)
        if element is not None:
            self.close_to(element)

    def finish(self) -> None:
        self.cut()
        while self.at is not self.top:
            self.close()


def _parse(page: str) -> _Builder:
    builder, at = _Builder(), 0
    # Behind the last ">" there are no tags, but there may be a comment.
    reach = page.rfind(">") + 1
    while (tag := _TAG.search(page, at, reach)) is not None:
        if tag.start() > at:
            builder.add(page[at : tag.start()])
        at = tag.end()
        name = tag[2]
        if name is None:
            continue
        name = name.lower()
        if tag[1]:
            builder.end(name)
        elif name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*+>", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
            if name == "title":
                builder.cut()
        elif name in VOID:
            if name == "br":
                builder.add("\n")
            elif name == "hr":
                builder.cut()
        else:
            builder.open(name, tag[3])
            if tag[3].endswith("/") and name in ("svg", "path", "use", "g"):
                builder.close()
    if at < len(page):
        builder.add(page[at:].split("<!--")[0])
    builder.finish()
    return builder


def _named(builder: _Builder) -> list[bool]:
    """Which blocks names put beside the text, or leave outside its root."""
    inside = 0
    for _, owner in builder.blocks:
        inside |= 0 if owner.out else owner.roots
    root = next((bit for bit in _BIT.values() if inside & bit), 0)
    out = [o.out or bool(root) and not o.roots & root for _, o in builder.blocks]
    if root != _BIT["article"]:
        return out
    # Title and lead of a main part come before its article.
    for i, (_, owner) in enumerate(builder.blocks):
        if not owner.out and owner.roots & root:
            break
        lead = owner
        while lead.tag not in BLOCK and lead.parent is not None:
            lead = lead.parent
        if not owner.out and owner.roots & _BIT["main"] and lead.tag in _LEAD:
            out[i] = False
    return out


def _may_recur(element: _Element, beside: bool) -> bool:
    """Whether an element may be a template by itself."""
    if element.roots & _BIT["article"]:
        return element.tag in STRUCTURE and element.end - element.first > 1
    if element.roots & _BIT["main"] or not beside:
        return element.tag in STRUCTURE
    return element.tag in BLOCK


def read_page(page: str | None) -> Page:
    """The blocks of a page, and every element that may recur with its blocks.

    These are elements of ``STRUCTURE`` that hold no article or main part; within
    an article they must hold two blocks at least, and outside the article or main
    part of a page that has any every block is one. ``named`` are blocks outside
    the article, the main part or else the body, and what tags, roles, classes or
    ids name as menu, header, footer, sidebar, notice, advert, form or comments,
    unless it holds the article. Scripts and styles are no text.
    """
    builder = _parse(page or "")
    for i, (_, owner) in enumerate(builder.blocks):
        if owner.first < 0:
            owner.first = i
        owner.end = i + 1
    for element in reversed(builder.elements):
        above = element.parent
        if element.first >= 0:
            above.first = element.first if above.first < 0 else min(above.first, element.first)
            above.end = max(above.end, element.end)
    for element in builder.elements:
        element.out = element.parent.out or element.beside and not element.holds
    # With an article or main part, all that lies outside them is beside the text.
    beside = any(e.holds or e.root in ("article", "main") for e in builder.elements)
    spans = [
        Span(e.hash, e.first, e.end)
        for e in builder.elements
        if e.first >= 0 and not e.root and not e.holds and _may_recur(e, beside)
    ]
    return Page([text for text, _ in builder.blocks], _named(builder), spans)


def text_blocks(page: str | None) -> list[str]:
    """The blocks of a page that nothing names as beside the text."""
    found = read_page(page)
    return [text for text, out in zip(found.blocks, found.named) if not out]
