"""Main text of web pages, without what a site repeats on its pages.

Pages are cut into blocks of text, and every element that may recur is the hash
of its subtree with the range of blocks it holds. Spark counts, per host, on how
many pages a subtree occurs; subtrees that recur on many pages of their host are
templates and are deleted. What tags, roles, classes or ids name as beside the
text goes then, as a check on pages whose templates do not recur.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm.html_blocks import read_page
from curbside.llm.tables import fresh, maybe_among, stored

MIN_PAGES = 5
MIN_SHARE = 0.2
# On so many pages a subtree is a template, however many more the host has.
MANY_PAGES = 100

_SPANS = "array<struct<subtree:bigint,first:int,end:int>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("subtree", pa.int64()), ("first", pa.int32()), ("end", pa.int32())])
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            blocks, named, spans, signs = [], [], [], []
            for html in part.column(0):
                page = read_page(html.as_py())
                texts = [b.encode("utf-8", "replace").decode() for b in page.blocks]
                own = "\n".join(b for b, out in zip(texts, page.named) if not out)
                blocks.append(texts)
                named.append(page.named)
                signs.append(xxhash.xxh64_intdigest(own.encode()))
                hashes = np.array([s.hash for s in page.spans], np.uint64).view(np.int64)
                spans.append(
                    [
                        {"subtree": h, "first": s.first, "end": s.end}
                        for h, s in zip(hashes.tolist(), page.spans)
                    ]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    *part.columns[1:],
                    pa.array(blocks, pa.list_(pa.string())),
                    pa.array(named, pa.list_(pa.bool_())),
                    pa.array(spans, pa.list_(span)),
                    pa.array(np.array(signs, np.uint64).view(np.int64)),
                ],
                names=[*part.schema.names[1:], "blocks", "named", "spans", "sign"],
            )


def host_of(url):
    """The lower-case host of an address, without user and port; else empty."""
    host = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(host, F.lit("")))


def extract_text(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    between: str = "\n",
    many_pages: int = MANY_PAGES,
    check_names: bool = True,
) -> DataFrame:
    """One row per page: id, url, ``text`` and ``n_chars``.

    Character references are decoded, white space within a block is one space,
    and blocks are joined by ``between``. Every element of a structure is counted,
    also what tags, roles, classes or ids name. A subtree on at least ``min_pages``
    distinct pages and ``min_share`` of all pages of its host, or on ``many_pages``
    of them, is a template, and its blocks go. A page with nothing but templates
    has an empty text, and pages of equal text count once. No heading, paragraph,
    list entry or cell of the text is a template by itself, within an article no
    element with a single block is, and nothing that holds an article is.
    ``check_names`` then takes out what lies outside the article or main part, and
    what names say is beside the text; without it the counts alone decide.

    Null and empty html, and pages without text, give an empty text. Pages
    without a host are taken as one host. Rows may repeat an id; each is a page
    of its own. An empty table gives no rows, and other columns are not looked at.
    """
    id_kind = pages.schema[id_col].dataType.simpleString()
    cut = stored(
        pages.select(
            F.col(html_col).alias("html"),
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            F.col(url_col).alias("url"),
            F.xxhash64(host_of(F.col(url_col))).alias("site"),
        ).mapInArrow(
            _cut,
            f"row bigint, id {id_kind}, url string, site bigint, blocks array<string>,"
            f" named array<boolean>, spans {_SPANS}, sign bigint",
        ),
        "page-blocks",
    )
    subtrees = F.explode(F.array_distinct(F.col("spans.subtree"))).alias("subtree")
    on_page = cut.select("site", "row", "sign", subtrees)
    totals = cut.groupBy("site").agg(F.count_distinct("sign").alias("pages"))
    counted = (
        on_page.groupBy("site", "subtree")
        .agg(F.count_distinct("sign").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    templates = counted.join(totals, "site").where(
        F.col("n") >= F.least(min_share * F.col("pages"), F.lit(float(many_pages)))
    )
    # Only pages with a template are touched again, and only their numbers.
    # What holds only blocks that go by their name needs no looking up.
    own = F.filter(
        "spans",
        lambda s: F.array_contains(F.slice("named", s["first"] + 1, s["end"] - s["first"]), False),
    )
    decides = own if check_names else F.col("spans")
    in_text = cut.select(
        "site", "row", F.explode(F.array_distinct(decides["subtree"])).alias("subtree")
    )
    touched = (
        in_text.join(templates.select("site", "subtree"), ["site", "subtree"])
        .groupBy(F.col("row").alias("touched"))
        .agg(F.collect_list("subtree").alias("templates"))
    )
    # No page has more templates than subtrees.
    touched = stored(touched, "templates")
    # Pages without a template stay where they are.
    may = maybe_among(touched.select(F.xxhash64("touched").alias("key")), F.xxhash64("row"))
    near = cut.where(may)
    joined = near.join(touched, near["row"] == touched["touched"], "left").drop("touched")
    untouched = cut.where(~may).withColumn("templates", F.lit(None).cast("array<bigint>"))
    joined = joined.unionByName(untouched)
    found = F.coalesce("templates", F.array().cast("array<bigint>"))
    taken = F.filter("spans", lambda s: F.array_contains(found, s["subtree"]))
    joined = joined.withColumn("taken", taken)

    def stays(block, i):
        inside = F.exists("taken", lambda s: (s["first"] <= i) & (i < s["end"]))
        return ~inside & ~F.get("named", i) if check_names else ~inside

    text = F.array_join(F.filter("blocks", stays), between)
    name = fresh("text")
    return joined.select("id", "url", text.alias(name)).select(
        F.col("id").alias(id_col),
        F.col("url").alias(url_col),
        F.col(name).alias("text"),
        F.char_length(name).cast("long").alias("n_chars"),
    )
