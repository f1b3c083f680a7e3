"""Toxic spans by a linear-chain conditional random field; document scores and offsets from its marginals.

Labels name documents, so tokens are labelled from them first: a word, or its first three to six letters, is a sign when
it stands in many different contexts of toxic documents (a passage copied many times is one context) and seldom elsewhere,
by a likelihood ratio. In a toxic document the tokens with a precise sign are toxic, all others and those of clean
documents are not. The field has two states, a weight for each sign, and weights for each step between states; it is fitted by
gradient ascent on the likelihood, with forward and backward sums over sentences of at most ``PIECE`` tokens.

A document's score is the chance that any of its tokens is toxic, 1 - prod(1 - p) over marginals p; spans are runs of tokens
with p of one half or more, as offsets of characters. A marginal counts only if it is at least ``FLOOR`` and more than any that a sentence
without signs can have, so the length of a text alone raises no score, and only sentences with signs need the sums. Whole texts are read.

Learning reads at most ``max_rows`` labelled rows, those with the smallest hash of their id (a documented bound). Signs are
counted by Spark; what is fitted is bounded by the sample. Null and empty texts score like any text without signs.
Repeated rows give repeated results; only ``doc_id`` and ``text`` are read. Without toxic examples, or
without labels, there are no signs and no text scores above the floor.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from obslake.llm.common import batches, crc_remainder, texts
from obslake.llm.nbsvm import sample

PIECE = 64
FLOOR = 0.01
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_TOKEN = re.compile(r"\S+")
_CACHED = 300_000


def signs_of(token: str) -> list[str]:
    word = _EDGE.sub("", token).lower()
    if not word or len(word) > 64:
        return []
    return ["=" + word, *[word[:n] for n in range(3, 7) if len(word) > n]]


def pieces(words: list[str]) -> list[tuple[int, int]]:
    """Sentences as (first, end), longer ones cut after ``PIECE`` tokens."""
    out, first = [], 0
    for i, w in enumerate(words):
        if w[-1] in ".!?" or i - first == PIECE - 1:
            out.append((first, i + 1))
            first = i + 1
    if first < len(words):
        out.append((first, len(words)))
    return out


def marginals(on: np.ndarray, size: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chance of the toxic state per token, and the chances of each step between states per row.

    ``on``: rows by tokens, the score of the toxic state (the other one scores 0); ``size``: tokens of each row.
    Sums are kept at one per token, so nothing over- or underflows.
    """
    rows, width = on.shape
    odds = np.exp(np.clip(on, -30, 30))
    t00, t01, t10, t11 = np.exp(np.clip(step.ravel(), -30, 30))
    inside = np.arange(width)[None, :] < size[:, None]
    f0, f1 = np.empty((width, rows)), np.empty((width, rows))
    a0, a1 = 1 / (1 + odds[:, 0]), odds[:, 0] / (1 + odds[:, 0])
    f0[0], f1[0] = a0, a1
    for t in range(1, width):
        b0, b1 = a0 * t00 + a1 * t10, (a0 * t01 + a1 * t11) * odds[:, t]
        scale = 1 / (b0 + b1)
        go = inside[:, t]
        a0, a1 = np.where(go, b0 * scale, a0), np.where(go, b1 * scale, a1)
        f0[t], f1[t] = a0, a1
    chance, steps = np.zeros((rows, width)), np.zeros((rows, 4))
    r0, r1 = np.full(rows, 0.5), np.full(rows, 0.5)  # what follows, by the state before it
    for t in range(width - 1, -1, -1):
        go = inside[:, t]
        p0, p1 = f0[t] * r0, f1[t] * r1
        chance[:, t] = np.where(go, p1 / (p0 + p1), 0)
        if t:
            o0, o1 = r0, r1 * odds[:, t]
            w = np.stack([f0[t - 1] * t00 * o0, f0[t - 1] * t01 * o1, f1[t - 1] * t10 * o0, f1[t - 1] * t11 * o1], 1)
            steps += np.where(go[:, None], w / w.sum(1, keepdims=True), 0)
            b0, b1 = t00 * o0 + t01 * o1, t10 * o0 + t11 * o1
            scale = 1 / (b0 + b1)
            r0, r1 = np.where(go, b0 * scale, r0), np.where(go, b1 * scale, r1)
    return chance, steps


class Field:
    """A fitted field: signs with weights, the bias of the toxic state, and the steps."""

    def __init__(self, weights: dict[str, float], bias: float, step: np.ndarray) -> None:
        self.weights, self.bias, self.step = weights, bias, step
        alone, _ = marginals(np.full((PIECE, PIECE), bias), np.arange(1, PIECE + 1), step)
        self.rest = float(alone.max())
        self.least = max(FLOOR, self.rest + 1e-9)

    def token(self, token: str) -> float | None:
        """The sum of the token's weights; None without any sign."""
        found = [self.weights[s] for s in signs_of(token) if s in self.weights]
        return sum(found) if found else None


class Scorer:
    def __init__(self, field: Field) -> None:
        self.field, self.plain = field, set()

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and its toxic spans as (start, end, largest chance)."""
        words, plain = text.split(), self.plain
        odd = [i for i, w in enumerate(words) if w not in plain]
        signs: dict[int, float] = {}
        for i in odd:
            s = self.field.token(words[i])
            if s is not None:
                signs[i] = s
            elif len(words[i]) <= 64:
                if len(plain) >= _CACHED:
                    plain.clear()
                plain.add(words[i])
        if not signs:
            return self.field.rest * FLOOR, []
        cut = pieces(words)
        at = sorted(signs)
        kept, k = [], 0
        for a, b in cut:
            while k < len(at) and at[k] < a:
                k += 1
            if k < len(at) and at[k] < b:
                kept.append((a, b))
        cut = kept
        clean, toxic = 1.0, []
        for i in range(0, len(cut), 256):  # sentences go through a block at a time
            part = cut[i:i + 256]
            size = np.array([b - a for a, b in part])
            on = np.full((len(part), int(size.max())), self.field.bias)
            for r, (a, b) in enumerate(part):
                for j in range(a, b):
                    if j in signs:
                        on[r, j - a] += signs[j]
            chance, _ = marginals(on, size, self.field.step)
            clean *= float(np.prod(1 - np.where(chance >= self.field.least, chance, 0)))
            toxic += [(part[r][0] + t, float(chance[r, t])) for r, t in zip(*np.nonzero(chance >= max(0.5, self.field.least)))]
        return max(1 - clean, self.field.rest * FLOOR), _spans(text, toxic) if toxic else []


def _spans(text: str, toxic: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    wanted, out, before = dict(toxic), [], -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        if i in wanted:
            if before == i - 1:
                start, _, p = out[-1]
                out[-1] = (start, m.end(), max(p, wanted[i]))
            else:
                out.append((m.start(), m.end(), wanted[i]))
            before = i
    return out


def fit(rows: list[tuple[int, tuple[tuple[int, int], ...], tuple[int, ...]]], signs: list[str], rounds: int = 150, rate: float = 0.15,
        ridge: float = 0.5) -> Field:
    """``rows``: sentences as (length, ((place, sign), ...), toxic places); equal ones are summed up."""
    times = Counter(rows)
    blocks = []
    for low, width in ((0, 8), (8, 16), (16, 32), (32, PIECE)):  # of like length, to spare empty places
        part = sorted(r for r in times if low < r[0] <= width)
        if not part:
            continue
        n, size = np.array([times[r] for r in part], float), np.array([r[0] for r in part])
        where = np.array([(i, p, s) for i, r in enumerate(part) for p, s in r[1]], int).reshape(-1, 3)
        truth = np.zeros((len(part), width))
        for i, r in enumerate(part):
            truth[i, list(r[2])] = 1
        state, seen = truth.astype(int), np.zeros(4)
        for t in range(1, width):
            seen += np.bincount(state[:, t - 1] * 2 + state[:, t], n * (size > t), 4)
        blocks.append((n, size, where, truth, np.arange(width)[None, :] < size[:, None], seen))
    theta = np.zeros(len(signs) + 1 + 4)  # signs, bias, steps
    theta[len(signs)] = -3.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, rounds + 1):
        grad = -ridge * theta
        for n, size, where, truth, inside, seen in blocks:
            on = np.full(truth.shape, theta[len(signs)])
            np.add.at(on, (where[:, 0], where[:, 1]), theta[where[:, 2]])
            chance, steps = marginals(on, size, theta[-4:].reshape(2, 2))
            wrong = np.where(inside, truth - chance, 0) * n[:, None]
            grad[:len(signs)] += np.bincount(where[:, 2], wrong[where[:, 0], where[:, 1]], len(signs))
            grad[len(signs)] += wrong.sum()
            grad[-4:] += seen - n @ steps
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        theta += rate * (first / (1 - 0.9 ** k)) / (np.sqrt(second / (1 - 0.99 ** k)) + 1e-8)
    return Field(dict(zip(signs, theta[:len(signs)].tolist())), float(theta[len(signs)]), theta[-4:].reshape(2, 2).copy())


def find_signs(rows: DataFrame, min_contexts: int = 3, max_signs: int = 20_000) -> dict[str, float]:
    """Signs with their precision, from the sampled (label, text) rows."""

    def run(it):
        schema = pa.schema([("sign", pa.string()), ("context", pa.int64()), ("toxic", pa.int32()), ("n", pa.int64())])
        for batch in it:
            counts: Counter = Counter()
            for toxic, text in zip(batch["label"].to_pylist(), batch["text"], strict=True):
                words = text.as_py().split()
                if toxic:
                    found = {(s, zlib.crc32(before.encode())) for before, w in zip(["", *words], words) for s in signs_of(w)}
                    found |= {(s, -1) for s, _ in found}
                else:
                    found = {(s, 0) for w in set(words) for s in signs_of(w)}
                counts.update((s, c, toxic) for s, c in found)
            yield from batches([(s, c, toxic, n) for (s, c, toxic), n in counts.items()], schema, 20_000)

    size = rows.groupBy("label").count().collect()
    n1, n0 = (next((r["count"] for r in size if r["label"] == v), 0) for v in (1, 0))
    if not n1:
        return {}
    found = rows.select("label", "text").mapInArrow(run, "sign string, context long, toxic int, n long")
    # toxic documents with the sign, but no more than its contexts there: a passage in many copies counts once
    found = found.groupBy("sign", "context", "toxic").agg(F.sum("n").alias("n"))
    found = found.groupBy("sign").agg(F.least(F.sum(F.when(F.col("context") == -1, F.col("n")).otherwise(0)),
                                              F.sum(F.when((F.col("toxic") == 1) & (F.col("context") >= 0), 1).otherwise(0))).alias("a"),
                                      F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))
    share = F.lit(n1 / (n1 + max(n0, 1)))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    log = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    ratio = 2 * (log(a, (a + b) * share) + log(b, (a + b) * (1 - share)))
    min_ratio = 3 * np.log(n1 + n0) - 5  # more rows hold more chance finds
    found = found.where((a >= min_contexts) & (a / (a + b) > 0.5) & (ratio >= float(min_ratio)))
    found = found.orderBy(ratio.desc(), "sign").limit(max_signs)
    return {r["sign"]: r["a"] / (r["a"] + r["b"]) for r in found.collect()}


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 4, remainder: int = 2,
          max_rows: int = 6_000, precise: float = 0.8) -> Field:
    """The fitted field; sentences of clean documents without signs take part one in eight, by a hash."""
    rows = sample(docs, labels, label, (modulus, remainder, False), max_rows).persist()
    try:
        precision = find_signs(rows)
        signs = sorted(precision)
        number = {s: i for i, s in enumerate(signs)}

        def run(it):
            schema = pa.schema([("size", pa.int32()), ("places", pa.list_(pa.int32())), ("signs", pa.list_(pa.int32())), ("toxic", pa.list_(pa.int32()))])
            for batch in it:
                out = []
                for doc_id, toxic, text in zip(batch["doc_id"].to_pylist(), batch["label"].to_pylist(), batch["text"], strict=True):
                    words = text.as_py().split()
                    for a, b in pieces(words):
                        at = [(i - a, [s for s in signs_of(words[i]) if s in number]) for i in range(a, b)]
                        at = [(i, ss) for i, ss in at if ss]
                        if at or zlib.crc32(f"{doc_id} {a}".encode()) % 8 == 0:
                            out.append((b - a, [i for i, ss in at for _ in ss], [number[s] for _, ss in at for s in ss],
                                        [i for i, ss in at if toxic and max(precision[s] for s in ss) >= precise]))
                yield from batches(out, schema, 5_000)

        table = rows.select("doc_id", "label", "text").mapInArrow(
            run, "size int, places array<int>, signs array<int>, toxic array<int>").toArrow()
    finally:
        rows.unpersist()
    sentences = [(n, tuple(zip(places, found)), tuple(toxic)) for n, places, found, toxic in
                 zip(*(table[c].to_pylist() for c in ("size", "places", "signs", "toxic")))]
    return fit(sentences, signs)


def score(docs: DataFrame, field: Field, modulus: int = 4, remainder: int = 2, threshold: float = 0.3) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted and the spans."""
    sent = docs.sparkSession.sparkContext.broadcast(field)  # bounded by max_signs

    def run(it):
        scorer = Scorer(sent.value)
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())])
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("spans", pa.list_(span))])
        for batch in it:
            rows = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                value, spans = scorer.score(text.as_py())
                rows.append((doc_id, value, [{"start": a, "end": b, "chance": p} for a, b, p in spans]))
            yield from batches(rows, schema, 10_000)

    scored = texts(docs).mapInArrow(run, "doc_id long, score double, spans array<struct<start: long, end: long, chance: double>>")
    return scored.select("doc_id", (crc_remainder(F.col("doc_id"), modulus) == remainder).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "spans")
