"""Importance resampling towards a target distribution, by hashed n-grams.

Features are the runs of 1 to ``max_n`` words; a feature's bucket is the crc32 of
its bytes modulo ``buckets``. A bucket's gain is 1000 times the smoothed log ratio
of its share among the target's features and among the documents', rounded down;
a document's weight is the sum over its features. Adding Gumbel noise, from a hash
of the id, and keeping the greatest scores draws without replacement with
probabilities in proportion to exp(weight / 1000).

Head-tail vocabulary: words follow a power law, so a bounded head of frequent
words (``HEAD_WORDS``) with their exact CRC states, and of frequent pairs
(``HEAD_PAIRS``) with their buckets, is broadcast and answers most features by one
lookup. All other features take their CRC directly; a longer run continues the
state of the run before it. The head is taken from a bounded hash sample of the
documents (``HEAD_TEXTS``) and decides only which way a bucket is computed, never
its value: totals cover all features of all texts.

Bucket totals are summed in each task before the shuffle: ``buckets`` rows a task.
Only these totals, a table of fixed size, pass through the driver. Ranks come from
``positions``, without a window over the table.

Defined cases: null, empty and wordless texts have no features and weight 0; they
are scored but are eligible only from ``min_words`` words; rows that share an id
are rows of their own, ordered by weight and number of features where scores tie;
a null id has the noise of the empty id; empty tables give no rows or, as target,
gains from the smoothing alone; input columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import sample_by_id, save, small_batches
from starwash.llm.positions import with_position

#: bytes of words after lower-casing A-Z: digits, a-z and everything that is not ASCII
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
HEAD_TEXTS, HEAD_WORDS, HEAD_PAIRS = 2000, 20_000, 20_000


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "replace").lower())


class Head(NamedTuple):
    """Frequent words with their CRC states, frequent pairs with their buckets."""

    states: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int]


class _States(dict):
    """CRC states of the head's words; others are computed when asked for."""

    def __missing__(self, word: bytes) -> int:
        return zlib.crc32(word)


def head_vocabulary(documents: DataFrame, max_n: int, buckets: int, id_col: str, text_col: str, seed: int = 12) -> Head:
    total = documents.count()
    texts = sample_by_id(documents.select(id_col, text_col), id_col, HEAD_TEXTS, seed, total)

    def count(batches):
        one, two = Counter(), Counter()
        for frame in batches:
            for text in frame["t"]:
                words = words_of(text if isinstance(text, str) else None)
                one.update(words)
                if max_n > 1:
                    two.update(zip(words, words[1:]))
        rows = [(w, None, n) for w, n in one.most_common(HEAD_WORDS)] + [(a, b, n) for (a, b), n in two.most_common(HEAD_PAIRS)]
        yield pd.DataFrame(rows, columns=["a", "b", "n"])

    texts = texts.select(F.col(text_col).cast("string").alias("t"))
    counts = texts.mapInPandas(count, "a binary, b binary, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    pick = lambda only, rows: counts.filter(only).orderBy(F.desc("n"), "a", "b").limit(rows).collect()
    states = {bytes(r["a"]): zlib.crc32(r["a"]) for r in pick("b is null", HEAD_WORDS)}
    pairs = [(bytes(r["a"]), bytes(r["b"])) for r in (pick("b is not null", HEAD_PAIRS) if max_n > 1 else [])]
    return Head(states, {(a, b): zlib.crc32(b" " + b, zlib.crc32(a)) % buckets for a, b in pairs})


def feature_buckets(words: list[bytes], max_n: int, buckets: int, states: dict, pairs: dict) -> np.ndarray:
    """The bucket of every feature, repeats included."""
    now = np.fromiter(map(states.__getitem__, words), np.int64, len(words))
    found, runs = [now % buckets], now.tolist()
    for n in range(2, min(max_n, len(words)) + 1):  # a run's state continues that of the run without its last word
        spaced = [b" " + w for w in words[n - 1 :]]
        if n == 2:
            known = map(pairs.get, zip(words, words[1:]))
            if n == max_n:
                found.append(np.fromiter((zlib.crc32(w, s) % buckets if k is None else k for k, w, s in zip(known, spaced, runs)), np.int64, len(spaced)))
                break
        runs = [zlib.crc32(w, s) for w, s in zip(spaced, runs)]
        found.append(np.array(runs, np.int64) % buckets)
    return np.concatenate(found)


def bucket_totals(texts: DataFrame, head, max_n: int, buckets: int, text_col: str) -> np.ndarray:
    """Features of all ``texts`` in each bucket."""
    def count(batches):
        states, pairs = _States(head.value.states), head.value.pairs
        total = np.zeros(buckets, np.int64)
        for frame in batches:
            for text in frame["t"]:
                words = words_of(text if isinstance(text, str) else None)
                total += np.bincount(feature_buckets(words, max_n, buckets, states, pairs), minlength=buckets)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    rows = texts.select(F.col(text_col).cast("string").alias("t")).mapInPandas(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        out[r["bucket"]] = r["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray, buckets: int) -> np.ndarray:
    s_all, t_all = float(documents.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(documents.tolist(), target.tolist())], np.int64)


def weigh(documents: DataFrame, target: DataFrame, max_n: int = 1, buckets: int = 10_000, id_col: str = "doc_id",
          text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight) for every row of ``documents``."""
    spark = documents.sparkSession
    small_batches(spark)
    head = spark.sparkContext.broadcast(head_vocabulary(documents, max_n, buckets, id_col, text_col))
    gain = spark.sparkContext.broadcast(gains(bucket_totals(documents, head, max_n, buckets, text_col),
                                              bucket_totals(target, head, max_n, buckets, target_col), buckets))

    def run(batches):
        states, pairs = _States(head.value.states), head.value.pairs
        for frame in batches:
            rows = []
            for text in frame["t"]:
                words = words_of(text if isinstance(text, str) else None)
                found = feature_buckets(words, max_n, buckets, states, pairs)
                rows.append((len(words), len(found), int(gain.value[found].sum())))
            out = pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])
            out.insert(0, "doc_id", frame["i"].astype("Int64"))
            yield out

    return documents.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).mapInPandas(
        run, "doc_id long, n_words long, n_features long, weight long")


def resample(documents: DataFrame, target: DataFrame, percent: int = 10, min_words: int = 20, seed: int = 2024, max_n: int = 1,
             buckets: int = 10_000, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank); rank 1, 2, 3, ... of the drawn rows, null for others."""
    x = weigh(documents, target, max_n, buckets, id_col, text_col, target_col)
    noise = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(noise, 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    x = save(x.withColumn("score", (F.col("weight") + gumbel).cast("long")), "scores")
    eligible = x.filter(F.col("n_words") >= min_words)
    draw = percent * eligible.count() // 100
    ranked = with_position(eligible, [F.col("score").desc(), F.col("doc_id"), F.col("weight"), F.col("n_features")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = x.filter(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def drawn(documents: DataFrame, ranks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``documents`` (its ids unique) that were drawn."""
    ids = ranks.filter("rank is not null").select(F.col("doc_id").alias("_id"))
    return documents.join(ids, F.col(id_col) == F.col("_id"), "left_semi")
