"""Quality classifier: Naive Bayes support vectors.

A document is the set of its n-grams: words, and runs of one to three word shapes (``Xx``, ``x,``, ``|``, ``X!!``; a word equal
to the one before is marked). Each indicator is scaled by the log ratio of its smoothed frequency in the two classes,
rows are scaled to length one, and a linear hinge-loss model is fitted by dual coordinate descent. A logistic curve on
margins of held-out folds of the training rows turns margins into scores.

Learning reads at most ``max_rows`` labelled rows, those with the smallest hash of their id (a documented bound: the model
is fitted in one task; its size is bounded by ``max_rows`` and ``max_features``). n-grams are found where the texts lie.
Scoring covers every row's whole text, with the weights sent to the tasks once.

Null and empty texts are scored like any text without n-grams. Labels that are null or have no document are left out;
of several labels of an id the smallest counts. Repeated rows give repeated results. Without labelled rows, or with one class
only, the score is the smoothed share of label 1. Empty tables give no rows. Only ``doc_id`` (for the folds) and ``text`` are read from the documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import batches, crc_remainder, texts

_CACHED = 200_000
_RUNS = (re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(\W)\1+"))


def shape_of(word: str) -> str:
    """Letters as x, X or Xx, digits as 9, a run of the same mark as two of them; at most eight characters."""
    letters = lambda m: "X" if (w := m[0]).isupper() and len(w) > 1 else "Xx" if w[0].isupper() else "x"
    return _RUNS[2].sub(r"\1\1", _RUNS[1].sub("9", _RUNS[0].sub(letters, word)))[:8]


class Features:
    """The set of n-gram hashes of a text; hashes of words and shapes are remembered up to a bound."""

    def __init__(self) -> None:
        self.words: dict[str, tuple[int, int]] = {}
        self.runs: dict[tuple[int, ...], int] = {}

    def _word(self, word: str) -> tuple[int, int]:
        if len(self.words) >= _CACHED:
            self.words.clear()
        pair = zlib.crc32(b"w" + word.lower().encode()), zlib.crc32(b"s" + shape_of(word).encode())
        if len(word) <= 64:
            self.words[word] = pair
        return pair

    def _run(self, run: tuple[int, ...]) -> int:
        if len(self.runs) >= _CACHED:
            self.runs.clear()
        h = self.runs[run] = zlib.crc32(repr(run).encode())
        return h

    def of(self, text: str) -> set[int]:
        words = text.split()
        if not words:
            return set()
        known = self.words
        pairs = [known.get(w) or self._word(w) for w in words]
        ids = [p[0] for p in pairs]
        shapes = [p[1] for p in pairs]
        same = 1 << 32
        shapes = [shapes[0], *[s | same if a == b else s for s, a, b in zip(shapes[1:], ids, ids[1:])]]
        runs = {(s,) for s in shapes}
        runs.update(zip(shapes, shapes[1:]))
        runs.update(zip(shapes, shapes[1:], shapes[2:]))
        cached = self.runs
        out = set(ids)
        out.update([cached.get(r) or self._run(r) for r in runs])
        return out


class Model:
    """Feature hashes with their weights and log-count ratios, as arrays; a table by hash is built where texts are scored."""

    def __init__(self, ids: np.ndarray, w: np.ndarray, ratio: np.ndarray, bias: float, slope: float, offset: float) -> None:
        self.ids, self.w, self.ratio, self.bias, self.slope, self.offset = ids, w, ratio, bias, slope, offset

    @cached_property
    def weights(self) -> dict[int, tuple[float, float]]:
        return dict(zip(self.ids.tolist(), zip(self.w.tolist(), self.ratio.tolist())))

    def score(self, features: set[int]) -> float:
        weights = self.weights
        found = [weights[f] for f in features if f in weights]
        norm = sum([r * r for _, r in found]) ** 0.5 or 1.0
        margin = sum([w * r for w, r in found]) / norm + self.bias
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def dual_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, n: int, cost: np.ndarray, epochs: int, seed: int) -> np.ndarray:
    """Weights (the last one is the bias) of the L1-loss support vector machine over sparse rows, y in -1, 1."""
    w, alpha, order = np.zeros(n + 1), np.zeros(len(rows)), np.random.default_rng(seed)
    square = np.array([float(v @ v) + 1 for _, v in rows])
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, v = rows[i]
            g = y[i] * (w[at] @ v + w[n]) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), cost[i])
            if (d := new - alpha[i]):
                alpha[i] = new
                w[at] += d * y[i] * v
                w[n] += d * y[i]
                moved = max(moved, abs(d))
        if moved < 1e-3:
            break
    return w


def _logistic(margins: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset by Newton's method, with smoothed targets."""
    n1, n0 = float((y > 0).sum()), float((y < 0).sum())
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta, x = np.zeros(2), np.stack([margins, np.ones_like(margins)], 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-6 * np.eye(2)
        theta -= np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-6 * theta), -5, 5)
    return float(theta[0]), float(theta[1])


def fit(features: list[np.ndarray], labels: np.ndarray, min_count: int = 3, max_features: int = 200_000, cost: float = 1.0,
        epochs: int = 20, folds: int = 3, seed: int = 7) -> Model:
    y = np.where(labels == 1, 1.0, -1.0)
    share = (float((y > 0).sum()) + 1) / (len(y) + 2)
    if len(set(y.tolist())) < 2:
        return Model(np.empty(0, np.int64), np.empty(0), np.empty(0), 0.0, 0.0, float(np.log(share / (1 - share))))
    vocabulary, counts = np.unique(np.concatenate(features), return_counts=True)
    if (counts >= min_count).sum() > max_features:
        min_count = int(np.sort(counts)[-max_features])
    vocabulary = vocabulary[counts >= min_count][:max_features]
    rows = []
    for f in features:
        at = np.searchsorted(vocabulary, f)
        rows.append(at[vocabulary[np.minimum(at, len(vocabulary) - 1)] == f] if len(vocabulary) else at[:0])

    def train(use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n1, n0 = np.ones(len(vocabulary)), np.ones(len(vocabulary))
        for i in use:
            (n1 if y[i] > 0 else n0)[rows[i]] += 1
        ratio = np.log(n1 / n1.sum()) - np.log(n0 / n0.sum())
        scaled = [(r, ratio[r] / (np.linalg.norm(ratio[r]) or 1.0)) for r in (rows[i] for i in use)]
        small = {1.0: (y[use] > 0).sum(), -1.0: (y[use] < 0).sum()}  # both classes weigh the same
        costs = np.array([cost * len(use) / (2 * max(1, small[v])) for v in y[use]])
        return dual_descent(scaled, y[use], len(vocabulary), costs, epochs, seed), ratio

    def margins(use: np.ndarray, w: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        return np.array([w[r] @ ratio[r] / (np.linalg.norm(ratio[r]) or 1.0) + w[-1] for r in (rows[i] for i in use)])

    fold, held = np.random.default_rng(seed).integers(0, folds, len(y)), np.zeros(len(y))
    for k in range(folds):
        train_rows, test_rows = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        if len(test_rows) and len(set(y[train_rows].tolist())) == 2:
            held[test_rows] = margins(test_rows, *train(train_rows))
    slope, offset = _logistic(held, y)
    w, ratio = train(np.arange(len(y)))
    return Model(vocabulary, w[:-1], ratio, float(w[-1]), slope, offset)


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: tuple[int, int, bool], max_rows: int) -> DataFrame:
    """(doc_id, label, text) of at most ``max_rows`` labelled rows of the learning folds.

    ``learn``: modulus, remainder, and whether rows of that remainder learn (else all others do).
    """
    modulus, remainder, equal = learn
    fold = crc_remainder(F.col("doc_id"), modulus)
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    ids = ids.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ((fold == remainder) if equal else (fold != remainder)))
    ids = ids.groupBy("doc_id").agg(F.min("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    return texts(docs).join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])  # max_rows bounds what is broadcast


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, remainder: int = 0,
          max_rows: int = 6_000) -> Model:
    """The model, fitted in one task on the bounded sample: the driver gets its arrays only.

    Without labelled rows, or with one class, every text gets the class share as its score.
    """
    def run(it):
        features = Features()
        schema = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.int64()))])
        for batch in it:
            rows = [(i, y, sorted(features.of(t.as_py()))) for i, y, t in
                    zip(batch["doc_id"].to_pylist(), batch["label"].to_pylist(), batch["text"], strict=True)]
            yield from batches(rows, schema, 500)

    def fitted(it):
        rows = sorted(((i, y, np.asarray(f.values, np.int64)) for batch in it for i, y, f in
                       zip(batch["doc_id"].to_pylist(), batch["label"].to_pylist(), batch["features"], strict=True)), key=lambda x: x[0])
        model = fit([f for _, _, f in rows], np.array([y for _, y, _ in rows], int))
        yield pa.RecordBatch.from_pylist([{x: getattr(model, x).tobytes() for x in arrays} | {x: getattr(model, x) for x in numbers}])

    arrays, numbers = ("ids", "w", "ratio"), ("bias", "slope", "offset")
    rows = sample(docs, labels, label, (modulus, remainder, False), max_rows)
    rows = rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, features array<long>")
    schema = ", ".join([*(f"{x} binary" for x in arrays), *(f"{x} double" for x in numbers)])
    found = next(iter(rows.repartition(1).mapInArrow(fitted, schema).collect()), None)
    if found is None:  # no row, so there need be no task
        return fit([], np.empty(0, int))
    ids, w, ratio = (np.frombuffer(found[x], t) for x, t in zip(arrays, (np.int64, np.float64, np.float64)))
    return Model(ids, w, ratio, found["bias"], found["slope"], found["offset"])


def score(docs: DataFrame, model: Model, modulus: int = 5, remainder: int = 0, threshold: float = 0.3) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_features

    def run(it):
        features, model = Features(), sent.value
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        for batch in it:
            rows = [(i, model.score(features.of(t.as_py()))) for i, t in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True)]
            yield from batches(rows, schema, 10_000)

    scored = texts(docs).mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (crc_remainder(F.col("doc_id"), modulus) == remainder).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, unchanged, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_features

    @F.pandas_udf("double")
    def chance(batches_of_text: Iterator[pd.Series]) -> Iterator[pd.Series]:
        features, model = Features(), sent.value
        for text in batches_of_text:
            yield pd.Series([model.score(features.of(t or "")) for t in text])

    return docs.where(chance(F.col("text")) >= threshold)
