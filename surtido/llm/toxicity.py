"""Toxicity by a classifier chain: one linear model per category, in a fixed order.

A later model sees, beside the text's features, the log-odds that earlier models give to
earlier categories. It is trained on out-of-fold predictions, so it learns from the kind of
probability it will be given. Features are the shares of words and word beginnings of a text
that differ most between the labels; texts are read whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surtido.llm.common import by_value, pieces, stored

by_value(__name__)

CATEGORIES = ("quality", "toxic")
# Bounds of training: labelled rows, features per category, folds.
MOST_LABELLED = 8_000
FEATURES = 256
FOLDS = 4
LEAST_DOCUMENTS = 8
# Words added to a text's length, so that one word of a short text is not a large share.
SMOOTH_WORDS = 30
STARTS = range(3, 9)
PENALTY = 1.0
# Least probability of a toxic text.
LEAST_TOXIC = 0.5
REMEMBERED = 1 << 17
# Log-odds handed on along the chain stay within this range.
ODDS = 8.0

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Chain:
    """Features, their scale, and per category the weights: features, earlier ones, constant."""

    categories: tuple[str, ...]
    features: tuple[str, ...]
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]


def _features(word: str) -> list[str]:
    """The word itself, marked by its end, and its beginnings."""
    return [word + "$", *(word[:n] for n in STARTS if n <= len(word))]


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Ids(dict):
    """Numbers of a word's features; a word is remembered while there is room."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__()
        self.numbers = numbers

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = tuple(self.numbers[f] for f in _features(word) if f in self.numbers)
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids


def _values(text: str | None, ids: _Ids, size: int) -> np.ndarray:
    """log(1 + percentage of the words, and some more, that have the feature), per feature."""
    words = _words(text)
    found = np.fromiter(chain.from_iterable(map(ids.__getitem__, words)), np.int64)
    return np.log1p(100.0 * np.bincount(found, minlength=size) / (len(words) + SMOOTH_WORDS))


def _document_counts(batches: Iterator[pa.RecordBatch],
                     n_labels: int) -> Iterator[pa.RecordBatch]:
    """Per feature, the documents with it by category and label, summed over a batch."""
    for batch in batches:
        labels = [batch.column(1 + k).to_pylist() for k in range(n_labels)]
        counts: dict[str, list[int]] = defaultdict(lambda: [0] * (2 * n_labels))
        for i, text in enumerate(batch.column(0).to_pylist()):
            for feature in set(chain.from_iterable(map(_features, set(_words(text))))):
                row = counts[feature]
                for k in range(n_labels):
                    if labels[k][i] is not None:
                        row[2 * k + (labels[k][i] > 0)] += 1
        table = np.array(list(counts.values()), np.int64).reshape(-1, 2 * n_labels)
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), *(pa.array(c) for c in table.T)],
            ["feature", *(f"n{k}" for k in range(2 * n_labels))])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def _fit(x: np.ndarray, y: np.ndarray, steps: int = 120, memory: int = 8) -> np.ndarray:
    """Weights and constant of a ridge logistic regression, by L-BFGS."""
    n, m = x.shape
    w, history = np.zeros(m + 1), []
    if n == 0:
        return w

    def slope(w):
        z = x @ w[:-1] + w[-1]
        p = _sigmoid(z)
        loss = np.sum(np.logaddexp(0, z) - y * z) + 0.5 * PENALTY * (w[:-1] @ w[:-1])
        g = np.append(x.T @ (p - y) + PENALTY * w[:-1], np.sum(p - y) + 1e-3 * w[-1])
        return loss + 5e-4 * w[-1] ** 2, g

    loss, g = slope(w)
    for _ in range(steps):
        q, alphas = g.copy(), []
        for s, t, rho in reversed(history):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * t
        if history:
            s, t, _ = history[-1]
            q *= (s @ t) / (t @ t)
        else:
            q /= max(1.0, np.linalg.norm(g))
        for (s, t, rho), a in zip(history, reversed(alphas)):
            q += s * (a - rho * (t @ q))
        step, slant = 1.0, g @ q
        while True:
            new = w - step * q
            new_loss, new_g = slope(new)
            if new_loss <= loss - 1e-4 * step * slant or step < 1e-8:
                break
            step /= 2
        s, t = new - w, new_g - g
        if s @ t > 1e-12:
            history = [*history[-(memory - 1):], (s, t, 1.0 / (s @ t))]
        done = abs(loss - new_loss) <= 1e-7 * max(1.0, abs(loss))
        w, loss, g = new, new_loss, new_g
        if done:
            break
    return w


def _odds(p: np.ndarray) -> np.ndarray:
    return np.clip(np.log(np.maximum(p, 1e-9) / np.maximum(1 - p, 1e-9)), -ODDS, ODDS)


def _apply(x: np.ndarray, weights: Sequence[np.ndarray]) -> list[np.ndarray]:
    """Probabilities of all categories, each model fed with those before it."""
    found: list[np.ndarray] = []
    for w in weights:
        own = np.column_stack([x, *map(_odds, found)]) if found else x
        found.append(_sigmoid(own @ w[:-1] + w[-1]))
    return found


def fit_chain(x: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> list[np.ndarray]:
    """Weights per category; NaN labels are left out of that category's fits."""
    weights, earlier = [], []
    for k in range(labels.shape[1]):
        own = np.column_stack([x, *map(_odds, earlier)]) if earlier else x
        known = ~np.isnan(labels[:, k])
        held_out = np.zeros(len(x))
        for fold in np.unique(folds):
            train, test = known & (folds != fold), folds == fold
            w = _fit(own[train], labels[train, k])
            held_out[test] = _sigmoid(own[test] @ w[:-1] + w[-1])
        weights.append(_fit(own[known], labels[known, k]))
        earlier.append(held_out)
    return weights


def _train(frame: pd.DataFrame, size: int, categories: Sequence[str],
           n_folds: int) -> pd.DataFrame:
    frame = frame.sort_values(["place", "mark"])  # the same fit however the rows arrive
    x = np.array(frame["x"].tolist()).reshape(len(frame), size)
    scale = np.sqrt((x ** 2).mean(axis=0)) + 1e-6
    labels = frame[list(categories)].to_numpy(float)
    weights = fit_chain(x / scale, labels, (frame["place"] % n_folds).to_numpy())
    return pd.DataFrame({"part": range(len(weights) + 1),
                         "numbers": [scale.tolist(), *(w.tolist() for w in weights)]})


def learn(docs: DataFrame, labels: DataFrame, categories: Sequence[str] = CATEGORIES,
          id_col: str = "doc_id", text_col: str = "text",
          most_labelled: int = MOST_LABELLED, n_features: int = FEATURES, n_folds: int = FOLDS,
          least_documents: int = LEAST_DOCUMENTS) -> Chain:
    """The chain of the categories, in their order, from labelled documents.

    Learns from about ``most_labelled`` labelled rows, chosen by a hash of their doc_id: the
    ``n_features`` of each category are chosen from their counts, among those of at least
    ``least_documents`` rows. The rows' features are computed where the texts are; one task
    gets these numbers, bounded by the parameters whatever the texts, and fits all models.
    A row may lack the label of a category; no labelled rows give a chain that predicts 0.
    Several label rows of a doc_id count by their largest labels; null, empty and very long
    texts count like any other; repeated rows count as often as they are given.
    """
    labels = labels.select(F.col(id_col).alias("doc_id"), *categories).where(
        "doc_id IS NOT NULL").groupBy("doc_id").agg(
        *[F.max(F.col(c).cast("int")).alias(c) for c in categories])
    n = labels.count()
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    labels = labels.withColumn("place", place).where(
        F.col("place") < (1 << 20) * min(1.0, most_labelled / max(1, n)))
    rows = stored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast(
        "string").alias("text")).join(labels, "doc_id").select("text", *categories, "place"))

    count = len(categories)
    names = [f"n{k}" for k in range(2 * count)]
    counts = rows.select("text", *categories).mapInArrow(
        lambda batches: _document_counts(batches, count),
        "feature string, " + ", ".join(f"{c} bigint" for c in names)).groupBy("feature").agg(
        *[F.sum(c).alias(c) for c in names])
    counts = stored(counts.where(sum((F.col(c) for c in names), F.lit(0)) >= least_documents))
    totals = rows.agg(*[F.count_if(F.col(c) == v) for c in categories for v in (0, 1)]).first()
    features: set[str] = set()
    for k in range(count):
        no, yes = (F.col(names[2 * k + v]) / F.lit(float(max(1, totals[2 * k + v])))
                   for v in (0, 1))
        both = (F.col(names[2 * k]) + F.col(names[2 * k + 1])) / F.lit(
            float(max(1, totals[2 * k] + totals[2 * k + 1])))
        # The squared difference of the shares over its variance if there were none.
        gain = (yes - no) ** 2 / (both * (1 - both) + 1e-9)
        few = F.col(names[2 * k]) + F.col(names[2 * k + 1]) >= least_documents
        features |= {r["feature"] for r in counts.where(few).orderBy(
            F.desc(gain), "feature").limit(n_features).select("feature").collect()}
    ordered = sorted(features)
    numbers = {f: i for i, f in enumerate(ordered)}

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(numbers)
        for batch in batches:
            for piece in pieces(batch, "text"):
                x = [_values(t, ids, len(numbers)) for t in piece.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.list_(pa.float64())), *piece.columns[1:]],
                    ["x", *piece.schema.names[1:]])

    kinds = ", ".join(f"`{c}` int" for c in categories)
    measured = rows.select("text", *categories, "place", F.xxhash64("text").alias("mark")).mapInArrow(
        values, f"x array<double>, {kinds}, place bigint, mark bigint")
    fitted = measured.groupBy().applyInPandas(
        lambda frame: _train(frame, len(ordered), categories, n_folds),
        "part int, numbers array<double>")
    parts = {r["part"]: np.array(r["numbers"]) for r in fitted.collect()}
    if not parts:
        return Chain(tuple(categories), (), np.zeros(0), ())
    return Chain(tuple(categories), tuple(ordered), parts[0],
                 tuple(parts[k + 1] for k in range(count)))


def predict(docs: DataFrame, model: Chain, text_col: str = "text") -> DataFrame:
    """``p`` (array of probabilities, one per category) and ``row`` (the given row).

    A text without words, null or empty, has probability 0 of everything; so has every text
    if nothing was learned. Repeated rows get equal answers; an empty table gives no rows;
    columns may have any names.
    """
    categories, features = len(model.categories), model.features
    scale, weights = model.scale, model.weights
    numbers = {f: i for i, f in enumerate(features)}

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(numbers)
        for batch in batches:
            for piece in pieces(batch, "text"):
                texts = piece.column("text").to_pylist()
                found = np.zeros((len(texts), categories))
                if weights:
                    for start in range(0, len(texts), 256):
                        part = texts[start:start + 256]
                        x = np.array([_values(t, ids, len(features)) for t in part]) / scale
                        found[start:start + 256] = np.column_stack(_apply(x, weights))
                    found[[not _WORD.search(t or "") for t in texts]] = 0.0
                lists = pa.FixedSizeListArray.from_arrays(
                    pa.array(found.ravel()), categories).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([lists, piece.column("row")], ["p", "row"])

    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    rows = rows.select(F.col("row")[text_col].cast("string").alias("text"), "row")
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(worker, f"p array<double>, row {kind}")
