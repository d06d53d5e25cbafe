"""Quality: positive-unlabelled learning with the non-negative risk.

Trusted positives (labelled good), unlabelled web text (a sample of all
documents, labels unseen) and a class prior estimated from these two alone.
A linear model over text statistics minimises the non-negative unbiased risk
(logistic loss)

    prior * R_p(+1)  +  max(0, R_u(-1) - prior * R_p(-1))

by gradient steps that, when the second part is negative, go up along it
(so the model cannot push unlabelled text below what the prior allows).

The prior is estimated by best-bin estimation: a classifier of positives
against unlabelled text is fitted on one half; on the other half, the share of
unlabelled over the share of positive scores above a cut is an upper bound of
the prior, and the cut with the least bound (with its sampling error) is taken.

Features: square roots of the frequencies of shape trigrams (each character
mapped to one of ten classes), and steps of repetition, length and symbol
statistics of the whole text. Bounds: ``n_positive`` and ``n_unlabelled``
whole texts, chosen by a hash of the id, are fitted on; scoring is one narrow
pass over all documents.

Defined cases: a null or empty text is scored by its (zero) statistics; null
ids and labels are not trained on; with no positive label every score is 0.5;
repeated labels of one id count once (good if any says so). Columns named like
an output are replaced, all others are kept.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import id_fold, sample_by_id, small_batches
from starwash.llm.linear import DenseRows, curvature, fit_logistic, sigmoid

_STEPS = np.array([0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.8])
_LENGTH_STEPS = np.array([1, 3, 10, 30, 100, 300, 1000, 3000, 10000])
_SHAPES, _KINDS = 1000, 9
WIDTH = _SHAPES + (_KINDS - 1) * len(_STEPS) + len(_LENGTH_STEPS)


def _shape_of(c: str) -> int:
    if c == "\n":
        return 0
    if c.isspace():
        return 1
    if c.islower():
        return 2
    if c.isupper():
        return 3
    if c.isdigit():
        return 4
    if c.isalpha():
        return 5
    if c in ".,;:'\"-()":
        return 6
    if c in "!?":
        return 7
    if c in "|=_~/\\<>[]{}":
        return 8
    return 9


_TABLE: list = []


def _shapes(text: str) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(np.array([_shape_of(chr(c)) for c in range(0x3000)], dtype=np.int64))
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(codes < 0x3000, _TABLE[0][np.minimum(codes, 0x2FFF)], 5)


def features(text: str | None) -> np.ndarray:
    """The feature vector of one whole text."""
    out = np.zeros(WIDTH, dtype=np.float32)
    text = text or ""
    words = text.split()
    if not words:
        return out
    shape = _shapes(text)
    if len(shape) > 2:
        tri = shape[:-2] * 100 + shape[1:-1] * 10 + shape[2:]
        out[:_SHAPES] = np.sqrt(np.bincount(tri, minlength=_SHAPES) / len(tri))
    n, chars = len(words), len(shape)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x]
    kinds = np.bincount(shape, minlength=10) / chars
    stats = np.array([
        sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(counts) / n,
        counts.most_common(1)[0][1] / n if n > 4 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1),
        kinds[3], kinds[8] + kinds[9], kinds[7], kinds[4],
    ])
    out[_SHAPES : _SHAPES + 8 * len(_STEPS)] = (stats[:, None] >= _STEPS).ravel()
    out[_SHAPES + 8 * len(_STEPS) :] = n >= _LENGTH_STEPS
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    prior: float

    def score_texts(self, texts) -> np.ndarray:
        z = [float(features(t if isinstance(t, str) else "") @ self.weights) for t in texts]
        return sigmoid(np.asarray(z, dtype=float) + self.bias)


def estimate_prior(pos: np.ndarray, unl: np.ndarray, delta: float = 0.1) -> float:
    """Best-bin estimate of the share of positives in the unlabelled sample."""
    half = np.arange(len(pos)) % 2 == 0, np.arange(len(unl)) % 2 == 0
    x = np.concatenate([pos[half[0]], unl[half[1]]])
    y = np.r_[np.ones(half[0].sum()), np.zeros(half[1].sum())]
    weight = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    w, b = fit_logistic(DenseRows(x), y, 1e-3, steps=150, weight=weight)
    sp, su = np.sort(pos[~half[0]] @ w + b), np.sort(unl[~half[1]] @ w + b)
    if not len(sp) or not len(su):
        return 0.5
    share_p = 1 - np.searchsorted(sp, sp) / len(sp)
    share_u = 1 - np.searchsorted(su, sp) / len(su)
    error = np.sqrt(np.log(4 / delta) / (2 * len(su))) + np.sqrt(np.log(4 / delta) / (2 * len(sp)))
    best = int(np.argmin((share_u + error) / share_p))
    return float(np.clip(share_u[best] / share_p[best], 0.01, 0.99))


def fit(positive: list[str], unlabelled: list[str], l2: float = 3e-4, steps: int = 800) -> QualityModel:
    if not positive or not unlabelled:
        return QualityModel(np.zeros(WIDTH, np.float32), 0.0, 0.5)
    pos = np.stack([features(t) for t in positive])
    unl = np.stack([features(t) for t in unlabelled])
    prior = estimate_prior(pos, unl)
    x = np.concatenate([pos, unl])
    rows, n_pos = DenseRows(x), len(pos)
    each_p, each_u = prior / n_pos, 1 / len(unl)
    rate = 1 / (0.3 * max(each_p, each_u) * (curvature(rows) + rows.n))
    w, b, speed_w, speed_b = np.zeros(WIDTH), 0.0, np.zeros(WIDTH), 0.0
    for _ in range(steps):
        p = sigmoid(np.asarray(rows.dot(w), dtype=float) + b)
        # softplus losses: of a label -1 the loss is -log(1 - p)
        negative = (-np.log1p(-np.minimum(p[n_pos:], 1 - 1e-12)).sum() * each_u
                    + np.log1p(-np.minimum(p[:n_pos], 1 - 1e-12)).sum() * each_p)
        if negative >= 0:
            g = np.concatenate([(p[:n_pos] - 1) * each_p - p[:n_pos] * each_p, p[n_pos:] * each_u])
        else:
            g = np.concatenate([p[:n_pos] * each_p, -p[n_pos:] * each_u])
        speed_w = 0.9 * speed_w - rate * (np.asarray(rows.tdot(g), dtype=float) + l2 * w)
        speed_b = 0.9 * speed_b - rate * float(g.sum())
        w, b = w + speed_w, b + speed_b
    return QualityModel(w.astype(np.float32), float(b), prior)


def train(documents: DataFrame, labels: DataFrame, in_training=None, n_positive: int = 3000,
          n_unlabelled: int = 5000, seed: int = 23, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> QualityModel:
    """Fit from trusted positives and a sample of all documents as the unlabelled side."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
    if in_training is not None:
        known = known.filter(in_training)
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).filter("_y = 1").select("_id")
    docs = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    # the positives' ids are at most n_positive rows
    trusted = docs.join(F.broadcast(sample_by_id(known, "_id", n_positive, seed, known.count())), "_id")
    web = sample_by_id(docs.filter("_id is not null"), "_id", n_unlabelled, seed + 1, docs.count())
    both = trusted.select("_id", "_text", F.lit(1).alias("_p")).unionByName(web.select("_id", "_text", F.lit(0).alias("_p")))
    sample = both.toPandas().sort_values(["_p", "_id"], kind="stable")
    texts = sample["_text"].fillna("")
    return fit(texts[sample["_p"] == 1].tolist(), texts[sample["_p"] == 0].tolist())


def score(documents: DataFrame, model: QualityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """All documents with ``score`` (0 to 1) and ``predicted`` (score >= threshold)."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # WIDTH weights

    @F.pandas_udf("double")
    def quality_score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score_texts(texts.tolist()))

    return (documents.withColumn("score", quality_score(F.col(text_col).cast("string")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def training_rows(folds: int = 5, held: int = 0):
    """The labels to learn from: crc32 of the id as text, modulo ``folds``, is not ``held``."""
    return id_fold("_id", folds) != held
