"""Toxicity: a character n-gram linear classifier with naive Bayes scaling.

A text's features are the distinct character n-grams (n = 4, 5, 6, hashed) of
its lower-cased, space-normalised characters. Each feature is scaled by its
naive Bayes log-count ratio between toxic and clean training texts, and a
logistic regression is fitted on the scaled features (NB-SVM).

The model is fitted on a bounded sample of labelled rows: at most
``per_class`` of either label, whole texts, chosen by a hash of the id. It is
at most ``max_features`` weights, whatever the corpus. Scoring is one narrow
pass over all documents, whole texts, in Arrow batches; nothing is shuffled
but the sample's ids.

Defined cases: a null or empty text has the score of the bias alone; rows with
null ids or null labels are not trained on; repeated labels of one id count
once (toxic if any says so); with labels of one class only, or none, every text
gets the smoothed share of toxic labels. Columns of the input named like an
output (``score``, ``predicted``) are replaced; all others are kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import id_fold, sample_by_id, save, small_batches
from starwash.llm.linear import BinaryRows, fit_logistic, sigmoid

#: n-gram lengths, and bits of the hashed feature space
LENGTHS, BITS = (4, 5, 6), 20


@dataclass
class ToxicityModel:
    ids: np.ndarray      # sorted feature ids
    weights: np.ndarray  # one weight per id, the ratio folded in
    bias: float

    def score_texts(self, texts) -> np.ndarray:
        full = np.zeros(1 << BITS, dtype=np.float32)
        full[self.ids] = self.weights
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            out[k] = self.bias
            if isinstance(text, str) and text:
                grams = ngram_ids(text)
                hit = grams[full[grams] != 0]
                if len(hit):
                    out[k] += float(full[np.unique(hit)].sum())
        return sigmoid(out)


def ngram_ids(text: str) -> np.ndarray:
    """Hashed ids of all character n-grams, with repeats."""
    codes = np.frombuffer((" " + " ".join(text.lower().split()) + " ").encode("utf-32-le", "replace"), dtype=np.uint32)
    out = []
    with np.errstate(over="ignore"):
        for n in LENGTHS:
            if len(codes) >= n:
                h = np.full(len(codes) - n + 1, n, dtype=np.uint32)
                for j in range(n):
                    h = h * np.uint32(0x01000193) ^ codes[j : len(codes) - n + 1 + j]
                h ^= h >> np.uint32(15)
                out.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint32)


def _grams(sample: DataFrame) -> DataFrame:
    """(i, y, ids): the distinct features of the sampled texts, taken on the executors."""
    def run(batches):
        for frame in batches:
            ids = [np.unique(ngram_ids(t if isinstance(t, str) else "")).astype("<u4").tobytes() for t in frame["t"]]
            yield pd.DataFrame({"i": frame["i"], "y": frame["y"], "ids": ids})

    return save(sample.mapInPandas(run, "i long, y int, ids binary"), "toxic-grams")


def _kept(grams: DataFrame, n_pos: int, n_neg: int, max_features: int, min_docs: int, alpha: float) -> pd.DataFrame:
    """(feature, ratio) of the features that tell the classes apart, at most ``max_features``."""
    def run(batches):
        count = np.zeros((2, 1 << BITS), np.int32)
        for frame in batches:
            for y, ids in zip(frame["y"], frame["ids"]):
                count[y][np.frombuffer(ids, "<u4")] += 1
        at = np.flatnonzero(count.any(0))
        yield pd.DataFrame({"feature": at.astype(np.int32), "neg": count[0][at], "pos": count[1][at]})

    x = grams.mapInPandas(run, "feature int, neg int, pos int").groupBy("feature").agg(
        (F.sum("neg") + alpha).alias("neg"), (F.sum("pos") + alpha).alias("pos"))
    ratio = F.log(F.col("pos") / (n_pos + 2 * alpha)) - F.log(F.col("neg") / (n_neg + 2 * alpha))
    x = x.withColumn("ratio", ratio).withColumn("sure", F.abs("ratio") / F.sqrt(1 / F.col("pos") + 1 / F.col("neg")))
    x = x.filter((F.col("sure") > 2.0) & (F.col("pos") + F.col("neg") >= min_docs + 2 * alpha))
    return x.orderBy(F.desc("sure"), "feature").limit(max_features).select("feature", "ratio").toPandas().sort_values("feature")


def fit(sample: DataFrame, prior: float, max_features: int = 1 << 15, min_docs: int = 4, alpha: float = 1.0, l2: float = 1e-3) -> ToxicityModel:
    """Fit on a written table (i, y, t) of labelled texts. ``prior`` is the toxic share of all
    training labels: the sample is balanced, so the bias is moved back to it. Features are
    counted on the executors; the driver gets the kept ones only, four bytes for each."""
    grams = _grams(sample)
    counts = {r["y"]: r["n"] for r in grams.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_pos, n_neg = counts.get(1, 0), counts.get(0, 0)
    if not n_pos or not n_neg:
        return ToxicityModel(np.empty(0, np.int64), np.empty(0), float(np.log(prior / (1 - prior))))
    kept = _kept(grams, n_pos, n_neg, max_features, min_docs, alpha)
    keep, ratio = kept["feature"].to_numpy(), kept["ratio"].to_numpy()
    shared = grams.sparkSession.sparkContext.broadcast(keep)

    def run(batches):
        place = np.full(1 << BITS, -1, np.int32)
        place[shared.value] = np.arange(len(shared.value))
        for frame in batches:
            cols = [place[np.frombuffer(ids, "<u4")] for ids in frame["ids"]]
            yield pd.DataFrame({"i": frame["i"], "y": frame["y"], "cols": [c[c >= 0].astype("<i4").tobytes() for c in cols]})

    rows = grams.mapInPandas(run, "i long, y int, cols binary").toPandas().sort_values("i", kind="stable")
    y = rows["y"].to_numpy(dtype=float)
    sizes = (rows["cols"].str.len() // 4).to_numpy()
    cols = np.frombuffer(b"".join(rows.pop("cols")), "<i4")
    w, b = fit_logistic(BinaryRows(cols, sizes, ratio), y, l2, steps=300)
    b += np.log(prior / (1 - prior)) - np.log(n_pos / n_neg)
    return ToxicityModel(keep, w * ratio, float(b))


def train(documents: DataFrame, labels: DataFrame, in_training=None, per_class: int = 2000, seed: int = 11,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Fit from labelled rows; ``in_training`` is a condition on the id (default: all)."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
    if in_training is not None:
        known = known.filter(in_training)
    known = known.groupBy("_id").agg(F.max("_y").alias("_y")).filter("_y in (0, 1)")
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    picked = [sample_by_id(known.filter(F.col("_y") == y), "_id", per_class, seed, n) for y, n in ((1, n1), (0, n0))]
    # the sample's ids are at most 2 * per_class rows
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    sample = (documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(chosen, "_id")
              .groupBy("_id").agg(F.min("_text").alias("t"), F.max("_y").alias("y")).withColumnRenamed("_id", "i"))
    small_batches(documents.sparkSession)
    return fit(sample.select(F.col("i").cast("long"), "y", "t"), (n1 + 1) / (n1 + n0 + 2))


def score(documents: DataFrame, model: ToxicityModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """All documents with ``score`` (0 to 1) and ``predicted`` (score >= threshold)."""
    small_batches(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # at most max_features weights

    @F.pandas_udf("double")
    def toxic_score(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score_texts(texts.tolist()))

    return (documents.withColumn("score", toxic_score(F.col(text_col).cast("string")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def training_rows(folds: int = 4, held: int = 2):
    """The labels to learn from: crc32 of the id as text, modulo ``folds``, is not ``held``."""
    return id_fold("_id", folds) != held
