"""Quality classifier: naive Bayes support vectors (op 5).

Features are indicators of a text's word one- and two-grams (A-Z lower-cased, punctuation left on),
and of character-class shapes of words, hashed to BUCKETS places. Each indicator is scaled by the
log ratio of its smoothed class counts; a linear model with hinge loss is fitted to these by dual
coordinate descent. Classes are weighted by their inverse frequency. Scores are a logistic function
of the margin, so 0.5 is the decision boundary; the texts' language, source, id and label are never
inputs.

The fit uses a sample of at most SAMPLE labelled training rows, taken by the least hash of doc_id;
that bound is the model's only one. Scoring covers every document and every word of it.

Labels other than 0 and 1, and null doc_ids, train nothing; a doc_id labelled twice differently
trains nothing either. Without rows of both classes the score is the constant share of class 1 (0.5
without any row). Null and empty texts have only the bias. Rows with a null doc_id are scored;
held_out is then null. Repeated rows are scored each, empty tables give no rows. Only doc_id,
text and quality are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import append, aside, map_rows, raw_text, restored
from .words import mix, ngram_hashes, word_hashes

USES = ("words", "nbsvm")
BITS = 18
BUCKETS = 1 << BITS
SAMPLE, EPOCHS, COST, SMOOTHING = 12_000, 12, 1.0, 1.0
#: Words to a shape: letter case, digits and other signs, runs taken together.
_SHAPE = bytes(
    ord("A") if 65 <= b <= 90 else ord("a") if 97 <= b <= 122 or b >= 128 else ord("0") if 48 <= b <= 57 else b
    for b in range(256))
_SHAPES: dict[bytes, bytes] = {}


def drop_caches() -> None:
    _SHAPES.clear()


def shape(word: bytes) -> bytes:
    """'Thon.' is 'Aa.': classes of characters, each run as one; a long shape is its hash."""
    s = _SHAPES.get(word)
    if s is None:
        if len(_SHAPES) > 100_000:
            _SHAPES.clear()
        t = word.translate(_SHAPE)
        s = b"\0" + bytes(c for i, c in enumerate(t) if not i or c != t[i - 1])
        s = s if len(s) <= 17 else b"\1" + xxhash.xxh3_128_digest(s)
        if len(word) <= 64:
            _SHAPES[word] = s
    return s


def features(text: bytes | None) -> np.ndarray:
    """The sorted distinct buckets of a text."""
    words = (text or b"").split()
    if not words:
        return np.zeros(0, np.int32)
    h = word_hashes((text or b"").lower().split())
    shapes = mix(word_hashes([shape(w) for w in words]))
    grams = np.concatenate([mix(h), ngram_hashes(h, 2), shapes, ngram_hashes(shapes, 2)])
    return np.unique((grams >> np.uint64(64 - BITS)).astype(np.int32))


@dataclass
class Model:
    """weights already hold the log-count ratios; margin = weights[features].sum() / sqrt(n) + bias."""

    weights: np.ndarray
    bias: float
    scale: float

    def score(self, x: np.ndarray) -> float:
        m = (float(self.weights[x].sum(dtype=np.float64)) / math.sqrt(len(x)) if len(x) else 0.0) + self.bias
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.scale * m))))


def fit(rows: list[np.ndarray], y: np.ndarray, seed: int = 7) -> Model:
    """Log-count ratios, then dual coordinate descent for the L2-regularised hinge loss.

    Rows are divided by the root of their number of features, so that long texts do not outweigh.
    """
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(BUCKETS, np.float32), math.log(share / (1 - share)), 1.0)
    count = np.full((2, BUCKETS), SMOOTHING)
    for x, c in zip(rows, y, strict=True):
        count[int(c), x] += 1
    ratio = np.log(count[1] / count[1].sum()) - np.log(count[0] / count[0].sum())
    sign = np.where(y == 1, 1.0, -1.0)
    cap = COST * len(y) / (2 * np.where(y == 1, (y == 1).sum(), (y == 0).sum()))
    value = lambda x: ratio[x] / math.sqrt(max(1, len(x)))
    square = np.array([float(np.square(value(x)).sum()) + 1.0 for x in rows])
    w, b, alpha = np.zeros(BUCKETS), 0.0, np.zeros(len(y))
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(y)).tolist():
            x, v = rows[i], value(rows[i])
            grad = sign[i] * (float(w[x] @ v) + b) - 1.0
            new = min(max(alpha[i] - grad / square[i], 0.0), cap[i])
            if step := (new - alpha[i]) * sign[i]:
                w[x] += step * v
                b += step
                alpha[i] = new
    margins = np.array([float(w[x] @ value(x)) + b for x in rows])
    return Model((w * ratio).astype(np.float32), b, _logistic_scale(margins, sign, cap))


def _logistic_scale(m: np.ndarray, sign: np.ndarray, weight: np.ndarray) -> float:
    """The slope of the logistic curve that fits the margins best; no offset, so the boundary stays."""
    slopes = np.geomspace(0.25, 4, 33)
    loss = [float((weight * np.logaddexp(0, -s * sign * m)).sum()) for s in slopes]
    return float(slopes[int(np.argmin(loss))])


def held_out(col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(col).cast("string").cast("binary")) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows that are not held out; at most `sample` of them reach the fit."""
    good = (labels.select("doc_id", F.col(target).cast("int").alias("y")).filter("doc_id IS NOT NULL AND y IN (0, 1)")
            .filter(~held_out()).groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).filter("y = y2"))
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "y")

    def rows(it: Iterator[tuple]) -> Iterator[tuple]:
        for doc_id, y, text in it:
            yield doc_id, y, features(text).tobytes()

    # the sample is at most `sample` rows of 12 bytes; a doc_id found in several rows trains once
    texts = docs.select("doc_id", raw_text().alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    got = (map_rows(texts, rows, "doc_id long, y int, x binary", USES).groupBy("doc_id", "y").agg(F.min("x").alias("x"))
           .toArrow().sort_by("doc_id"))
    # views of the Arrow buffers, a few kilobytes a row
    return fit([np.frombuffer(x.as_buffer(), np.int32) for x in got["x"]], got["y"].to_numpy().astype(np.int64))


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` and the score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 1 MB, whatever the corpus
    return append(docs, text, lambda texts: [(sent.value.score(features(t)),) for t in texts], "score double", keep, USES)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    return score(docs, train(docs, labels), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents with a score of `least` or more; all columns stay."""
    named = [f"_col{i}" for i in range(len(docs.columns))]
    scored = score(aside(docs), model, named, named[docs.columns.index("text")])
    return restored(scored.filter(F.col("score") >= least), docs.columns)
