"""A character trigram model of the corpus, and a decoder of disguised words.

The alphabet is fixed, so that the model has the same size for any corpus: the
boundary between words, the letters of Latin-1, and one class for all else.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(
    chr(c) for c in range(0xDF, 0x100) if chr(c).isalpha()
)
BOUNDARY, OTHER = 0, len(LETTERS) + 1
SIZE = len(LETTERS) + 2

# Letters that a sign may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
    "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "€": "e",
    "£": "l", "(": "c", "¢": "c",
}

# Log probabilities of what the channel does to a letter.
SUBSTITUTE, INSERT, REPEAT, SPACE = -2.0, -3.0, -1.0, -1.5

_CLASS = {c: i + 1 for i, c in enumerate(LETTERS)}
_CODES = np.full(0x110000, OTHER, np.int32)
_CODES[[ord(c) for c in LETTERS]] = np.arange(1, OTHER)
_CODES[[*range(9, 14), 32]] = BOUNDARY

_EDGES = ".,;:?!\"'`´“”‘’„«»()[]{}<>&%#*$~_-–—…/\\=+^|"
# In front of a word these may well be its first letter.
_FRONT = _EDGES.translate({ord(c): None for c in "!$|+"})
_TRIPLE = re.compile(r"(.)\1\1")
_DOUBLE = re.compile(r"(.)\1")
# Behind a word these may well be its last letters.
_LAST = re.compile(r"[^\W\d_]([$+|]+)[^\w$+|]*$")
# Three or more single signs that are set apart, as in "b a d".
_SPACED = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SIZE**3, np.int64)
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py()
            for start in range(0, len(text or ""), 1 << 20):
                # Two signs of overlap keep the trigrams across the cut.
                piece = text[max(0, start - 2) : start + (1 << 20)].lower()
                raw = f" {piece} ".encode("utf-32-le", "replace")
                codes = _CODES[np.frombuffer(raw, np.uint32)]
                grams = (codes[:-2] * SIZE + codes[1:-1]) * SIZE + codes[2:]
                total += np.bincount(grams, minlength=SIZE**3)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(total[used])], names=["gram", "n"]
    )


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities ``[a, b, c]`` of ``c`` after ``a b``, over all texts.

    Null texts count as empty. A corpus without text gives the flat model.
    """
    grams = (
        docs.select(text_col)
        .mapInArrow(_count, "gram int, n bigint")
        .groupBy("gram")
        .agg(F.sum("n").alias("n"))
    )
    # At most SIZE**3 rows, whatever the corpus.
    counts = np.zeros(SIZE**3)
    for gram, n in grams.collect():
        counts[gram] = n
    counts = counts.reshape(SIZE, SIZE, SIZE)
    one = (counts.sum((0, 1)) + 1) / (counts.sum() + SIZE)
    two = counts.sum(0)
    two = (two + 20 * one) / (two.sum(1, keepdims=True) + 20)
    three = (counts + 20 * two) / (counts.sum(2, keepdims=True) + 20)
    return np.log(three).astype(np.float32)


class Decoder:
    """Finds the words behind leetspeak, spacing and repetition."""

    def __init__(self, model: np.ndarray) -> None:
        self.model = model

    def _arcs(self, token: str):
        """For each run of a sign, what may be meant and its log probability."""
        at = 0
        while at < len(token):
            sign, end = token[at], at + 1
            while end < len(token) and token[end] == sign:
                end += 1
            run, at = end - at, end
            if sign == " ":
                yield [("", SPACE), (" ", 0.0)]
            elif sign.isalpha():
                if run == 1:
                    yield [(sign, 0.0)]
                elif run == 2:
                    yield [(sign * 2, 0.0), (sign, REPEAT)]
                else:
                    yield [(sign, REPEAT), (sign * 2, 2 * REPEAT)]
            else:
                arcs = [("", INSERT), (sign, 0.0)]
                for letter in LEET.get(sign, ""):
                    arcs.append((letter, SUBSTITUTE))
                    if run > 1:
                        arcs.append((letter * 2, 2 * SUBSTITUTE))
                yield arcs

    def viterbi(self, token: str) -> str:
        """The likeliest reading of one token, or of signs set apart."""
        model = self.model
        states = {(BOUNDARY, BOUNDARY): (0.0, None)}
        for arcs in self._arcs(token):
            following: dict = {}
            for (a, b), (score, path) in states.items():
                for text, cost in arcs:
                    x, y, total = a, b, score + cost
                    for sign in text:
                        c = BOUNDARY if sign == " " else _CLASS.get(sign, OTHER)
                        total += float(model[x, y, c])
                        x, y = y, c
                    best = following.get((x, y))
                    if best is None or total > best[0]:
                        following[x, y] = (total, (path, text) if text else path)
            states = following
        path = max(
            (score + float(model[a, b, BOUNDARY]), i, path)
            for i, ((a, b), (score, path)) in enumerate(states.items())
        )[2]
        parts = []
        while path:
            path, text = path
            parts.append(text)
        return "".join(reversed(parts))

    def words(self, token: str) -> tuple[str, ...]:
        """The words behind a lower-case token without white space.

        A token that may be a word as it is comes first, then what else it may be.
        """
        more = ()
        last = _LAST.search(token)
        if last is not None:
            # Signs at the end as letters, beside the word without them.
            letters = "".join(LEET[sign][0] for sign in last[1])
            more = self._readings(token[: last.start(1)].lstrip(_FRONT) + letters)
        return tuple(dict.fromkeys((*self._plain(token), *more)))

    def _plain(self, token: str) -> tuple[str, ...]:
        if not token.isalpha():
            token = token.rstrip(_EDGES).lstrip(_FRONT)
            if not any(map(str.isalpha, token)):
                return ()
        return self._readings(token)

    def _readings(self, token: str) -> tuple[str, ...]:
        if token.isalpha() and not _TRIPLE.search(token):
            if _DOUBLE.search(token):
                return tuple(dict.fromkeys((token, self.viterbi(token))))
            return (token,)
        read = self.viterbi(token)
        return tuple(w for w in re.split(r"[\W_]+", read) if w)

    def spaced(self, text: str) -> list[str]:
        """Words found in single signs that are set apart."""
        found = []
        for match in _SPACED.finditer(text):
            signs = re.sub(r"(\S)(?: \1){2,}(?!\S)", r"\1", " ".join(match[0].split()))
            if len(signs) > 4:
                found += [w for w in self.viterbi(signs).split() if len(w) > 2]
        return found
