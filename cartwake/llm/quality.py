"""Quality classifier: naive Bayes support vectors over hashed n-grams.

Indicators of n-grams are scaled by the log-count ratio of the two classes, then a linear
hinge-loss model is fitted by dual coordinate descent.  The ratios count all labelled
training rows; the fit uses ``FIT_ROWS`` of each class, chosen by hash, and
a fifth of them sets the probability curve.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake.llm.common import others, per_text, slices, text_of
from cartwake.sources.files import stored

BUCKETS = 1 << 18
#: Bound of the fit: labelled rows of each class.
FIT_ROWS = 3000
HELD_OUT = 2

_SEEN = np.zeros(BUCKETS, dtype=bool)


def features(text: str | None) -> np.ndarray:
    """Buckets of the n-grams in a text, each once, ascending.

    N-grams: single words, pairs of words, runs of three bytes.  In a pair, a word that
    repeats the one before it counts as one fixed sign; three equal words in a row are an
    n-gram of their own.
    """
    raw = (text or "").encode("utf-8", "replace")
    found = []
    if len(raw) >= 3:
        b = np.frombuffer(raw, np.uint8).astype(np.uint32)
        found.append(_bucket(b[:-2] << 16 | b[1:-1] << 8 | b[2:]))
    words = raw.split()
    if words:
        h = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        found.append(_bucket(h ^ np.uint32(0x5BD1E995)))
        same = h[1:] == h[:-1]
        pair = h[:-1] * np.uint32(0x85EBCA6B) ^ h[1:]
        pair[same] = 7
        if (same[1:] & same[:-1]).any():
            pair = np.append(pair, np.uint32(8))
        found.append(_bucket(pair * np.uint32(0xC2B2AE35)))
    if not found:
        return np.zeros(0, np.int64)
    mark = np.concatenate(found)
    if len(mark) < 1024:
        return np.unique(mark).astype(np.int64)
    # For long texts a table of all buckets is faster than sorting.
    _SEEN[mark] = True
    at = np.flatnonzero(_SEEN)
    _SEEN[at] = False
    return at


def _bucket(grams: np.ndarray) -> np.ndarray:
    return grams * np.uint32(0x9E3779B1) >> np.uint32(32 - 18)


def _scale(n: int) -> float:
    """Long texts do not outweigh others, short ones are not blown up."""
    return 1 / np.sqrt(n + 300)


@dataclass
class Model:
    """Weights per bucket, and the curve from a margin to a probability."""

    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def score(self, text: str | None) -> float:
        at = features(text)
        margin = self.bias
        if len(at):
            margin += float(self.weights[at].sum()) * _scale(len(at))
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30))))


def log_ratios(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int, alpha: float = 1.0) -> np.ndarray:
    """Log of the ratio of smoothed shares of documents that have an n-gram."""
    p = (good + alpha) / (n_good + 2 * alpha)
    q = (bad + alpha) / (n_bad + 2 * alpha)
    return np.where(good + bad > 1, np.log(p / q), 0.0)


def fit_hinge(rows: list[np.ndarray], y: np.ndarray, ratio: np.ndarray, cost: np.ndarray, rounds: int = 12, seed: int = 0):
    """Dual coordinate descent for the hinge loss; ``y`` is -1 or 1, ``cost`` per row."""
    w, bias = np.zeros(len(ratio)), 0.0
    alpha = np.zeros(len(rows))
    norms = np.array([float(np.sum(np.square(ratio[r]))) * _scale(len(r)) ** 2 + 1.0 for r in rows])
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(rows)):
            r = rows[i]
            x = ratio[r] * _scale(len(r))
            g = y[i] * (float(w[r] @ x) + bias) - 1.0
            new = min(max(alpha[i] - g / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * x
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def fit_curve(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, with Platt's smoothed targets."""
    n1, n0 = good.sum(), (~good).sum()
    goal = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        d, w = goal - p, np.maximum(p * (1 - p), 1e-9)
        h = np.array([[np.sum(w * margin**2) + 1e-6, np.sum(w * margin)], [np.sum(w * margin), np.sum(w) + 1e-6]])
        step = np.linalg.solve(h, np.array([np.sum(d * margin), np.sum(d)]))
        step = np.clip(step, -2, 2)
        a, b = max(a + step[0], 1e-3), b + step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(texts: list[str], good: list[bool], ratio: np.ndarray, strength: float = 10.0) -> Model:
    """The model of some texts; with one class or none, its share for every text."""
    return fit_buckets([features(t).astype(np.int32) for t in texts], good, ratio, strength)


def fit_buckets(rows: list[np.ndarray], good: list[bool], ratio: np.ndarray, strength: float = 10.0) -> Model:
    """As ``fit``, from the buckets of each text."""
    y = np.array(good, dtype=bool)
    if y.all() or not y.any():
        p = (y.sum() + 1) / (len(y) + 2)
        return Model(np.zeros(len(ratio)), 0.0, 1.0, float(np.log(p / (1 - p))))
    check = np.arange(len(rows)) % 5 == 4
    if len({*y[check].tolist()}) < 2:
        check[:] = False
    share = np.where(y, len(y) / (2 * y.sum()), len(y) / (2 * (~y).sum()))
    own = np.flatnonzero(~check)
    w, bias = fit_hinge([rows[i] for i in own], np.where(y[own], 1.0, -1.0), ratio, strength * share[own])
    weights = w * ratio
    margin = np.array([bias + weights[r].sum() * _scale(len(r)) for r in rows])
    used = check if check.any() else ~check
    slope, offset = fit_curve(margin[used], y[used])
    return Model(weights, bias, slope, offset)


def held_out(doc_id: Column) -> Column:
    """Whether a row never takes part in training."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "utf-8")), F.lit(4)) == HELD_OUT, F.lit(False))


def _class_counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Documents of each class that have each n-gram; two fixed-size arrays."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in slices(batches, "text"):
            for t, q in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                counts[q, features(t)] += 1
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[0, at]), pa.array(counts[1, at])], ["bucket", "bad", "good"])

    sums = rows.mapInArrow(count, "bucket long, bad long, good long").groupBy("bucket").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    got = sums.toArrow()  # at most BUCKETS rows
    good, bad = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = got.column("bucket").to_numpy()
    good[at], bad[at] = got.column("good").to_numpy(), got.column("bad").to_numpy()
    return good, bad


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", fit_rows: int = FIT_ROWS) -> Model:
    """A model of the labelled documents that are not held out.

    Labels are 0 or 1; rows with another label, without a label or without an id are not
    used.  An id with both labels counts once for each.  Only texts are inputs.  The fit
    takes ``fit_rows`` different (id, text) of each class, those of the lowest hashes, and
    gets their buckets, at most BUCKETS numbers a text; repeats of a row take up no place.
    """
    marks = labels.where(F.col(f"`{label}`").isin(0, 1) & F.col(f"`{doc_id}`").isNotNull() & ~held_out(F.col(f"`{doc_id}`")))
    marks = marks.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("label")).distinct()
    # The same join at every size; labels grow with the documents.
    rows = docs.select(F.col(f"`{doc_id}`").alias("_id"), text_of(f"`{text}`").alias("text")).join(marks.hint("merge"), "_id")
    rows = stored(rows.select("_id", "text", "label"), "labelled")
    sizes = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    good, bad = _class_counts(rows)
    ratio = log_ratios(good, bad, sizes.get(1, 0), sizes.get(0, 0))
    # Hashes first, then the texts they belong to: a repeated row is one hash.
    hashed = rows.select("label", F.xxhash64("_id", "text").alias("h"))
    lowest = [hashed.where(F.col("label") == q).select("h").distinct().orderBy("h").limit(fit_rows).agg(F.max("h")).first()[0] for q in sizes]
    chosen = [(F.col("label") == q) & (F.xxhash64("_id", "text") <= h) for q, h in zip(sizes, lowest)]
    part = rows.where(F.lit(False) if not chosen else chosen[0] | chosen[-1]).dropDuplicates(["label", "_id", "text"])
    found = _buckets_of(part).collect()  # at most fit_rows of each class
    found.sort(key=lambda r: (r.label, str(r["id"]), r.h))
    return fit_buckets([np.frombuffer(r.buckets, np.int32) for r in found], [r.label == 1 for r in found], ratio)


def _buckets_of(rows: DataFrame) -> DataFrame:
    keep = rows.select("label", F.col("_id").alias("id"), F.xxhash64("_id", "text").alias("h"), "text")

    def work():
        return lambda texts: [pa.array([features(t).astype(np.int32).tobytes() for t in texts], pa.binary())]

    return per_text(keep, "text", ["label", "id", "h"], {"buckets": "binary"}, work)


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (all by default) and ``score``; null texts count as empty.

    A column named ``score``, in any case, is replaced.
    """
    keep = others(docs.columns if keep is None else keep, ["score"])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS doubles

    def work():
        own = shared.value
        return lambda texts: [pa.array([own.score(t) for t in texts], pa.float64())]

    return per_text(docs, text, keep, {"score": "double"}, work)
