"""Toxicity of whole texts, scored on what the noise of disguise has hidden.

Every text is read through a noisy channel: a character model of the corpus
tells which word a disguised one stands for. Words and word beginnings that
labelled texts show to go with toxicity make the features of a logistic model.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.llm import charmodel
from curbside.llm.tables import fresh, stored

# Labelled rows that the classifier is fitted on at most.
SAMPLE = 20_000
BEGINNINGS = (4, 5, 6)
CACHED = 200_000


class _Reader:
    """Distinct features of texts, with the readings of tokens kept."""

    def __init__(self, model: np.ndarray) -> None:
        self.decoder = charmodel.Decoder(model)
        self.kept: dict[str, tuple[str, ...]] = {}

    def _named(self, word: str) -> list[str]:
        return [word, *[word[:n] + "~" for n in BEGINNINGS if len(word) > n]]

    def of_token(self, token: str) -> tuple[str, ...]:
        out = self.kept.get(token)
        if out is None:
            if len(self.kept) >= CACHED:
                self.kept.clear()
            words = self.decoder.words(token)
            out = self.kept[token] = tuple(f for w in words for f in self._named(w))
        return out

    def of_text(self, text: str | None) -> tuple[int, set[str]]:
        """The number of tokens and the distinct features."""
        low = (text or "").lower()
        tokens = low.split()
        found: set[str] = set()
        for token in set(tokens):
            found.update(self.of_token(token))
        for word in self.decoder.spaced(low):
            found.update(self._named(word))
        return len(tokens), found


def _tally(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, bad, good = _Reader(model), Counter(), Counter()

        def flush():
            names = list({**bad, **good})
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([bad[x] for x in names], pa.int64()),
                    pa.array([good[x] for x in names], pa.int64()),
                ],
                names=["feature", "bad", "good"],
            )

        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                (bad if toxic else good).update(reader.of_text(text.as_py())[1])
                if len(bad) + len(good) > 1_000_000:
                    yield flush()
                    bad.clear(), good.clear()
        yield flush()

    return run


def _evidence(hits: list[float], tokens: int) -> list[float]:
    strength = sum(hits)
    return [
        1.0,
        min(1.0, len(hits)),
        math.log1p(strength),
        max(hits, default=0.0),
        math.log1p(100 * len(hits) / max(tokens, 1)),
        math.log1p(tokens) * bool(hits),
    ]


_WIDTH = len(_evidence([], 0))


def _measure(model: np.ndarray, weights: dict[str, float], name: str = "evidence"):
    """Evidence of each text; all columns but the first, the text, pass on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model)
        known: dict[str, tuple[tuple[str, float], ...]] = {}
        for batch in batches:
            rows = []
            for text in batch.column(0):
                low = (text.as_py() or "").lower()
                tokens, hits = low.split(), {}
                for token in set(tokens):
                    found = known.get(token)
                    if found is None:
                        if len(known) >= CACHED:
                            known.clear()
                        found = known[token] = tuple(
                            (f, weights[f]) for f in reader.of_token(token) if f in weights
                        )
                    if found:
                        hits.update(found)
                for word in reader.decoder.spaced(low):
                    hits.update(
                        (f, weights[f]) for f in reader._named(word) if f in weights
                    )
                rows.append(_evidence(list(hits.values()), len(tokens)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(rows, pa.list_(pa.float64()))],
                names=[*batch.schema.names[1:], name],
            )

    return run


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[0, 0] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + penalty, x.T @ (y - p) - penalty @ w
        )
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class ToxicityModel:
    """What was learnt: the character model, feature weights, and the fit."""

    def __init__(self, characters, weights, fit) -> None:
        self.characters, self.weights, self.fit = characters, weights, fit

    def score(
        self, docs: DataFrame, text_col: str, *keep: str, name: str = "score"
    ) -> DataFrame:
        """The columns ``keep`` and the score under ``name``."""
        evidence = fresh("evidence")
        chosen = docs.select(F.col(text_col).alias(fresh("text")), *keep)
        kinds = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[1:]
        )
        measured = chosen.mapInArrow(
            _measure(self.characters, self.weights, evidence),
            f"{kinds}, {evidence} array<double>",
        )
        logit = sum(
            (F.col(evidence)[i] * float(w) for i, w in enumerate(self.fit)), F.lit(0.0)
        )
        return measured.select(*keep, (1 / (1 + F.exp(-logit))).alias(name))


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> ToxicityModel:
    """Learn from ``labels``; the character model is of all ``docs``.

    At most ``sample`` labelled documents are used, chosen by a hash of the id.
    A document with several labels has the largest; null labels and ids do not
    count, and of rows that repeat an id the smallest text is read. Without labels of both kinds every score is the share of label 1.
    """
    characters = charmodel.train(docs, text_col)
    chosen = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("labelled"))
        .agg((F.max(label_col) > 0).alias("toxic"))
        .orderBy(F.xxhash64("labelled"), "labelled")
        .limit(sample)
    )
    chosen = stored(chosen, "labelled")
    taught = docs.join(F.broadcast(chosen), docs[id_col] == chosen["labelled"]).select(
        docs[text_col].alias("text"), chosen["toxic"], chosen["labelled"]
    )
    # One row per label, however often an id is repeated.
    taught = taught.groupBy("labelled").agg(
        F.min("text").alias("text"), F.max("toxic").alias("toxic")
    )
    taught = stored(taught.select("text", "toxic"), "taught")
    bad, all_ = taught.agg(
        F.count(F.when(F.col("toxic"), 1)), F.count(F.lit(1))
    ).first()
    if not 0 < bad < all_:
        base = (bad + 0.5) / (all_ + 1) if all_ else 0.0
        fit = np.zeros(_WIDTH)
        fit[0] = math.log(max(base, 1e-6) / (1 - min(base, 1 - 1e-6)))
        return ToxicityModel(characters, {}, fit)
    rate = bad / all_
    tally = (
        taught.mapInArrow(_tally(characters), "feature string, bad bigint, good bigint")
        .groupBy("feature")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        .where("bad > 1")
    )
    tally = stored(tally, "tally")
    # How unlikely so many toxic texts are at the common rate, and that among
    # so many features half a one is that unlikely by chance.
    n = F.col("bad") + F.col("good")
    share = F.col("bad") / n
    surprise = F.col("bad") * F.log(share / rate) + F.when(
        F.col("good") > 0, F.col("good") * F.log((1 - share) / (1 - rate))
    ).otherwise(0.0)
    level = math.log(2 * max(1, tally.count()))
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5) * ((1 - rate) / rate))
    # The sample bounds the number of features.
    weights = dict(
        tally.where((share > rate) & (surprise > level)).select("feature", odds).collect()
    )
    measured = taught.mapInArrow(
        _measure(characters, weights), "toxic boolean, evidence array<double>"
    ).collect()
    x = np.array([r["evidence"] for r in measured])
    y = np.array([float(r["toxic"]) for r in measured])
    order = np.lexsort(np.column_stack([x, y]).T)
    return ToxicityModel(characters, weights, _fit(x[order], y[order]))


def held_out(id_col, parts: int, part: int):
    """Whether crc32 of the id as text leaves ``part``; a null id does not."""
    rest = F.crc32(F.col(id_col).cast("string")) % parts
    return F.coalesce(rest == part, F.lit(False))


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per document: id, ``held_out``, ``score`` and ``predicted``.

    Learns only from labels of ids whose crc32, as text, modulo 5 is not 0.
    Null and empty texts have the score of a text without any evidence. Rows may
    repeat an id; each has its own score. An empty table gives no rows, and
    columns other than id and text are not looked at.
    """
    learn = labels.where(~held_out(id_col, 5, 0))
    model = learn_toxicity(docs, learn, id_col, text_col, label_col, sample)
    scored = model.score(docs, text_col, id_col)
    return scored.select(
        id_col,
        held_out(id_col, 5, 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """The documents with a score below one half, with all their columns.

    See :func:`score_toxicity`; labels of ids that are held out are not used.
    """
    learn = labels.where(~held_out(id_col, 5, 0))
    model = learn_toxicity(docs, learn, id_col, text_col, label_col, sample)
    score = fresh("score")
    scored = model.score(docs, text_col, *docs.columns, name=score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)
