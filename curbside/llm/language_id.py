"""Languages of a text as a mixture, by expectation-maximisation.

Texts are cut into short windows. A window's likelihood under a language comes
from hashed byte trigrams, counted over all labelled texts. For each text the
shares of a set of languages are estimated; languages join the set one by one
as long as the likelihood gains more than the penalty for another language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
BUCKETS = 1 << 14
WINDOW = 32
ROUNDS = 12
# Trigrams overlap: each letter is in three of them.
TEMPER = 1 / 3
PENALTY = 3.0
# Trigrams whose likelihoods are held at a time.
_CHUNK = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def trigrams(text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the byte trigrams of the words of a text."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)
    letter = _LETTER[raw]
    # Of what is between two words one byte stays, as a blank.
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    data = np.where(letter, raw, 32)[keep].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    mixed = ((data[:-2] << 16) | (data[1:-1] << 8) | data[2:]) * np.uint32(2654435761)
    return ((mixed >> np.uint32(8)) % np.uint32(buckets)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return next(filter(str.isalpha, text or ""), None) is not None


def _count(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}

        def flush():
            names, at, n = [], [], []
            for lang, row in counts.items():
                used = np.flatnonzero(row)
                names += [lang] * len(used)
                at.append(used)
                n.append(row[used])
            counts.clear()
            none = [np.zeros(0, np.int64)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array(np.concatenate(at or none).astype(np.int32)),
                    pa.array(np.concatenate(n or none)),
                ],
                names=["lang", "bucket", "n"],
            )

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                if lang not in counts:
                    if len(counts) >= 256:
                        yield flush()
                    counts[lang] = np.zeros(buckets, np.int64)
                found = trigrams(text.as_py(), buckets)
                counts[lang] += np.bincount(found, minlength=buckets)
        yield flush()

    return run


class LanguageModel:
    """Log probabilities of trigram buckets, a row per bucket."""

    def __init__(self, langs: list[str], logs: np.ndarray) -> None:
        self.langs, self.logs = langs, logs

    def windows(self, text: str, size: int = WINDOW) -> np.ndarray:
        """Log likelihoods of the windows of a text, a row per window."""
        found = trigrams(text, self.logs.shape[0])
        parts = []
        step = _CHUNK // max(1, len(self.langs)) // size * size or size
        for start in range(0, len(found), step):
            part = found[start : start + step]
            parts.append(
                np.add.reduceat(self.logs[part], np.arange(0, len(part), size), axis=0)
            )
        if not parts:
            return np.zeros((1, len(self.langs)))
        return np.concatenate(parts).astype(np.float64) * TEMPER


def _shares(like: np.ndarray, starts: np.ndarray, doc: np.ndarray, allowed: np.ndarray):
    """Shares of the allowed languages and the log likelihood of each text."""
    sizes = np.bincount(doc, minlength=len(starts))[:, None]
    shares = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        part = like * shares[doc]
        part /= part.sum(1, keepdims=True)
        shares = np.add.reduceat(part, starts, axis=0) / sizes
    total = np.log((like * shares[doc]).sum(1))
    return shares, np.add.reduceat(total, starts)


def infer(windows: list[np.ndarray], penalty: float = PENALTY):
    """For each text the shares of its languages; others have none."""
    sizes = np.array([len(w) for w in windows])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    doc = np.repeat(np.arange(len(windows)), sizes)
    logs = np.concatenate(windows)
    first = np.add.reduceat(logs, starts, axis=0).argmax(1)
    # Never so small that a window has no language at all.
    like = np.exp(np.maximum(logs - logs.max(1, keepdims=True), -600))
    texts = np.arange(len(windows))
    chosen = np.zeros((len(windows), logs.shape[1]), bool)
    chosen[texts, first] = True
    shares, level = _shares(like, starts, doc, chosen)
    # Only a language that is the best of some window can gain.
    leading = np.zeros_like(chosen)
    leading[doc, logs.argmax(1)] = True
    open_ = (leading & ~chosen).any(1)
    while open_.any():
        gain = np.full(chosen.shape, -np.inf)
        tried: dict[int, tuple] = {}
        for lang in range(chosen.shape[1]):
            use = np.flatnonzero(open_ & leading[:, lang] & ~chosen[:, lang])
            if not len(use):
                continue
            rows = np.isin(doc, use)
            local = np.repeat(np.arange(len(use)), sizes[use])
            begin = np.concatenate([[0], np.cumsum(sizes[use])[:-1]])
            allowed = chosen[use].copy()
            allowed[:, lang] = True
            got, reached = _shares(like[rows], begin, local, allowed)
            gain[use, lang] = reached - level[use]
            tried[lang] = (use, got, reached)
        best = gain.argmax(1)
        better = gain[texts, best] > penalty + 0.5 * np.log(sizes)
        for lang, (use, got, reached) in tried.items():
            take = better[use] & (best[use] == lang)
            shares[use[take]], level[use[take]] = got[take], reached[take]
            chosen[use[take], lang] = True
        open_ &= better & (leading & ~chosen).any(1)
    return shares


def _predict(model: LanguageModel, penalty: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pred = [UNKNOWN] * batch.num_rows
            score = [0.0] * batch.num_rows
            sets: list[str] = [""] * batch.num_rows

            def settle(at, held):
                for row, share in zip(at, infer(held, penalty)):
                    order = sorted(np.flatnonzero(share > 0), key=lambda i: (-share[i], i))
                    pred[row] = model.langs[order[0]]
                    score[row] = min(1.0, float(share[order[0]]))
                    sets[row] = ",".join(model.langs[i] for i in order)

            at, held, size = [], [], 0
            for row, text in enumerate(batch.column(0)):
                text = text.as_py()
                if not model.langs or not has_letter(text):
                    continue
                at.append(row)
                held.append(model.windows(text))
                size += held[-1].size
                if size > 1 << 18:
                    settle(at, held)
                    at, held, size = [], [], 0
            if at:
                settle(at, held)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(pred, pa.string()),
                    pa.array(score, pa.float64()),
                    pa.array(sets, pa.string()),
                ],
                names=[*batch.schema.names[1:], "lang_pred", "score", "languages"],
            )

    return run


def learn_languages(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", buckets: int = BUCKETS
) -> LanguageModel:
    """Trigram counts of all rows with text and language.

    The driver gets at most ``buckets`` numbers for each language.
    """
    counts = (
        docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
        .select(text_col, F.col(lang_col).cast("string"))
        .mapInArrow(_count(buckets), "lang string, bucket int, n bigint")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(set(counts["lang"]))
    table = np.zeros((buckets, len(langs)))
    place = {lang: i for i, lang in enumerate(langs)}
    table[counts["bucket"].to_numpy(int), counts["lang"].map(place).to_numpy(int)] = (
        counts["n"].to_numpy()
    )
    logs = np.log((table + 0.5) / (table.sum(0) + 0.5 * buckets))
    return LanguageModel(langs, logs.astype(np.float32))


def identify_languages(
    docs: DataFrame,
    train: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    penalty: float = PENALTY,
) -> DataFrame:
    """One row per document: id, ``lang_pred``, ``score``, ``languages``.

    The model is learnt from the rows of ``train`` with text and language.
    ``score`` is the share of ``lang_pred`` in the text, and ``languages`` the
    chosen set, largest share first. Null texts and texts without a letter are
    ``und`` with score 0 and no languages; so is everything if there is nothing
    to learn from. Rows may repeat an id. An empty table gives no rows. Only the
    named columns are looked at.
    """
    model = learn_languages(train, text_col, lang_col)
    id_kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(text_col).alias("t"), F.col(id_col).alias("id"))
    found = texts.mapInArrow(
        _predict(model, penalty),
        f"id {id_kind}, lang_pred string, score double, languages string",
    )
    return found.select(F.col("id").alias(id_col), "lang_pred", "score", "languages")
