"""Small corpora for the text operators."""

import random
import re
import zlib

from pyspark.sql import functions as F

WORDS = [
    a + b + c
    for a in ("ka", "to", "mi", "su")
    for b in ("ren", "lo", "vi", "da", "po")
    for c in ("", "s", "ta", "nim", "or")
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# Columns that operators might use for themselves.
CLASHING = (
    "row", "id", "sign", "sha", "t", "fp", "size", "target", "taken", "kept", "words", "score",
    "evidence", "place", "block", "component_id", "text_sha256", "__salt", "item", "labelled",
    "toxic", "held_out", "keep_id", "root", "epoch", "key",
)


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def corpus(seed=1, n=60):
    """Documents with exact copies, near copies and repeated lines."""
    rng = random.Random(seed)
    line = sentence(rng, 9)
    rows = []
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randrange(5, 40)) for _ in range(rng.randrange(1, 5)))
        if i % 4 == 0:
            text += "\n" + line
        rows.append((i, text, "en" if i % 2 else "de", f"s{i % 3}", len(text)))
    for i in range(n, n + 30):
        _, text, lang, source, size = rows[rng.randrange(n)]
        if i % 3 == 0:
            text = text.replace(" ", "  ", 1)
        elif i % 3 == 1:
            words = text.split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        rows.append((i, text, lang, source, size))
    rng.shuffle(rows)
    return rows


LONG = sentence(random.Random(9), 40_000)

EDGES = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 3),
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 3),
    (1, "something else entirely under the same id", None, None, None),
    (2, None, None, None, None),
    (3, "", "de", "b", 0),
    (4, " \t\n ", "de", None, 4),
    (5, LONG, "en", "b", None),
    (6, "x", None, "a", 1),
    (7, "12345 !!", "de", "b", 8),
    (8, "é ü 漢字 \U0001f600 ok", "fr", "b", 9),
    (None, "alpha beta gamma delta epsilon zeta", "en", "a", 3),
    (None, None, None, None, None),
]


def table(spark, rows, clashing=False):
    df = spark.createDataFrame(rows, SCHEMA)
    return df.select("*", *[F.lit(7).alias(c) for c in CLASHING]) if clashing else df


def tokens(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def left(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def order(doc_id):
    return (doc_id is None, doc_id or 0)
