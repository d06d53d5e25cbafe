"""Spelling variants by k-d trees over letter counts.

Words are counted in each task first, so a frequent word costs one row a task.
Two words are near if one inserted, deleted or replaced letter makes them equal.
One edit changes the letter counts by at most two in L1 distance: by one letter
gained and one lost (equal lengths) or by one letter gained (lengths L and L + 1).

1. Cells: for each word length a k-d tree over letter-count vectors, split at
   medians of a bounded hash sample (``SAMPLE`` words) until a cell should hold at
   most ``cell_words``. Every word has one home cell, whatever the sample said.
2. A word asks all cells of its own length and of the next one whose box has
   vectors within its distance: box pruning. Cells that turn out large are split
   into tiles of homes and of askers, so no task grows with one cell or one
   multiset of letters.
3. In a cell a k-d tree over the distinct vectors answers the range searches of
   all askers together. Subtrees whose box is too far from an asker are pruned.
4. Vectors that fit give word pairs, whose letter order is verified: by comparing
   them in blocks, or, where many words share their letters, by meeting in the
   words without the letter in question, which makes no pairs of others.
5. Each task sends one row a word on: its number of near words and the best of
   them. Roots follow by pointer doubling over the table of forms.

No candidate is dropped: boxes prune only what is provably too far.

Defined cases: null and empty texts have no words; a null id counts as an empty id
in the hash; rows that share an id are counted row by row; an empty table gives no
rows; input columns other than id and text are not read, so they cannot clash.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import save, small_batches

_RUN = re.compile("[a-zÀ-ÿ]+")
LETTERS = 26 + 64  # a-z and U+00C0 to U+00FF
SAMPLE, MAX_CELLS, _LEAF, _BLOCK = 20_000, 4096, 64, 1 << 19
_HELD = 200_000  # distinct words that a task holds before it sends them on
_FAR = 1 << 14  # no count of a cell's bound is greater


class _Words(dict):
    """Numbers of the words seen since the last flush, with their CRCs and lengths in bytes."""

    def __init__(self):
        self.crc, self.size = array("q"), array("i")

    def __missing__(self, word: str) -> int:
        data = word.encode()
        self.crc.append(zlib.crc32(data))
        self.size.append(len(data))
        self[word] = n = len(self.crc) - 1
        return n


def _carried(start: int, size: int) -> int:
    """What a CRC state adds to the CRC of any ``size`` bytes after it: CRCs are linear."""
    zeros = bytes(size)
    return zlib.crc32(zeros, start) ^ zlib.crc32(zeros)


def word_counts(documents: DataFrame, typo_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) over all texts. With ``typo_every``, a run loses one letter in documents where
    h = crc32('<id>:<run>') is a multiple of it: the letter at h modulo the run's length.

    h is put together from the id's state and the run's own CRC, which is taken once for
    each word that a task holds."""
    small_batches(documents.sparkSession)

    def run(batches):
        words, total, edited = _Words(), np.zeros(0, np.int64), Counter()

        def flush():
            names = list(words)
            counts = Counter({w: n for w, n in zip(names, total[: len(names)].tolist()) if n})
            counts.update(edited)
            return pd.DataFrame({"word": list(counts), "n": list(counts.values())}).astype({"word": object, "n": "int64"})

        for frame in batches:
            found, ids = [], []
            for doc, text in zip(frame["i"], frame["t"]):
                if isinstance(text, str):
                    runs = _RUN.findall(text.encode("utf-8", "replace").lower().decode())
                    found.append(np.fromiter(map(words.__getitem__, runs), np.int64, len(runs)))
                    ids.append(doc)
            if not found:
                continue
            names, crc, size = None, np.array(words.crc), np.array(words.size)
            seen = np.concatenate(found)
            more = np.bincount(seen, minlength=len(crc))
            if typo_every and len(seen):
                sizes = np.unique(size[seen])
                place = np.searchsorted(sizes, size)
                for doc, at in zip(ids, found):
                    start = zlib.crc32(f"{doc}:".encode())
                    h = crc[at] ^ np.array([_carried(start, int(n)) for n in sizes])[place[at]]
                    hit = np.flatnonzero(h % typo_every == 0)
                    if len(hit):
                        names = names or list(words)
                        np.subtract.at(more, at[hit], 1)
                        for k, x in zip(at[hit].tolist(), h[hit].tolist()):
                            word = names[k]
                            cut = x % len(word)
                            edited[word[:cut] + word[cut + 1 :]] += 1
            more[: len(total)] += total
            total = more
            if len(words) >= _HELD:
                yield flush()
                words, total, edited = _Words(), np.zeros(0, np.int64), Counter()
        yield flush()

    texts = documents.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("i"), F.col(text_col).cast("string").alias("t"))
    return texts.mapInPandas(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def codes_of(words: list[str]) -> np.ndarray:
    """Letters of words of one length, as numbers 0 to 89."""
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.int16)
    return np.where(codes < 128, codes - 97, codes - 192 + 26)


def vectors_of(codes: np.ndarray) -> np.ndarray:
    rows = np.arange(len(codes))[:, None] * LETTERS
    return np.bincount((rows + codes).ravel(), minlength=len(codes) * LETTERS).reshape(-1, LETTERS).astype(np.int16)


def _split(points: np.ndarray) -> tuple[int, int] | None:
    """The widest letter and a median that leaves points on both sides (left: at most the median)."""
    low, high = points.min(0), points.max(0)
    letter = int(np.argmax(points.var(0))) if len(points) else 0
    if not len(points) or low[letter] == high[letter]:
        return None
    return letter, int(min(np.median(points[:, letter]), high[letter] - 1))


def cell_boxes(points: np.ndarray, n_words: int, cell_words: int, most: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(low, high) bounds of the leaves of a k-d tree over a sample: they cover all vectors, without overlap."""
    todo = [(points, float(n_words), np.zeros(LETTERS, np.int16), np.full(LETTERS, _FAR, np.int16))]
    done = []
    while todo:
        sample, n, low, high = todo.pop()
        cut = _split(sample) if n > cell_words and len(todo) + len(done) + 1 < most else None
        if cut is None:
            done.append((low, high))
            continue
        letter, at = cut
        left = sample[:, letter] <= at
        high_left, low_right = high.copy(), low.copy()
        high_left[letter], low_right[letter] = at, at + 1
        share = left.mean()
        todo += [(sample[left], n * share, low, high_left), (sample[~left], n * (1 - share), low_right, high)]
    return done


def _outside(vectors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters that each vector must gain, and lose, to get into the box."""
    at = np.flatnonzero((low > 0) | (high < _FAR))
    part = vectors[:, at]
    return np.maximum(low[at] - part, 0).sum(1), np.maximum(part - high[at], 0).sum(1)


def range_search(points: np.ndarray, askers: np.ndarray, lost: int):
    """Blocks (asker, point) of numbers with the point's vector one letter more than
    the asker's, and ``lost`` letters less: batched descent of a k-d tree."""
    used = np.flatnonzero(points.any(0) | askers.any(0))
    kind = np.int8 if max(points.max(initial=0), askers.max(initial=0)) < 64 else np.int16
    # letter by letter: sums over letters add whole rows
    points, askers = (np.ascontiguousarray(x[:, used].T.astype(kind)) for x in (points, askers))
    size, of_point = askers.sum(0, dtype=np.int16), points.sum(0, dtype=np.int16)
    todo = [(np.arange(points.shape[1]), np.arange(askers.shape[1]))]
    while todo:
        p, q = todo.pop()
        here = points[:, p]
        low, high = here.min(1), here.max(1)
        # letters that an asker lacks to reach the box, rarest first to go; then those it has too many of
        for letters, over, most in ((np.flatnonzero(low), False, 1), (np.flatnonzero(high < kind(16)), True, lost)):
            asks = askers[np.ix_(letters, q)] if len(letters) < len(used) else askers[:, q]
            bound = (high if over else low)[letters, None]
            far = np.maximum(asks, bound) - (bound if over else asks)
            q = q[far.sum(0, dtype=np.int16) <= most]
        if not len(q):
            continue
        if len(p) > _LEAF and (cut := _split(here.T)):
            left = here[cut[0]] <= cut[1]
            todo += [(p[left], q), (p[~left], q)]
            continue
        asks = askers[:, q]
        shared = np.zeros((len(q), len(p)), kind)  # letters in common
        for d in np.flatnonzero(high):
            shared += np.minimum(asks[d, :, None], here[d, None, :])
        a, b = np.nonzero((shared == size[q, None] - lost) & (of_point[None, p] - shared == 1))
        if len(a):
            yield q[a], p[b]


def _groups(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the number of each row's, and their counts: by hashes, checked."""
    weights = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, vectors.shape[1])
    with np.errstate(over="ignore"):
        mixed = vectors.astype(np.int64) @ weights
    _, first, group, count = np.unique(mixed, return_index=True, return_inverse=True, return_counts=True)
    if (vectors[first][group] != vectors).any():  # two vectors with one hash
        return np.unique(vectors, axis=0, return_inverse=True, return_counts=True)
    return vectors[first], group, count


def _replaced(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x != y).sum(1) == 1


def _inserted(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """y is x with one letter more: an equal beginning and an equal rest meet."""
    n = x.shape[1]
    ahead = np.logical_and.accumulate(x == y[:, :n], 1).sum(1)
    behind = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], 1).sum(1)
    return ahead + behind >= n


def _by_rest(x: list[str], y: list[str], lost: str | None, gained: str) -> list[tuple[int, int]]:
    """Near pairs of two groups of anagrams: words meet in what is left without the letters that differ."""
    met = defaultdict(set)
    for j, word in enumerate(y):
        for i, c in enumerate(word):
            if c == gained:
                met[word[:i] + word[i + 1 :], i if lost else -1].add(j)
    rests = lambda w: ((w[:i] + w[i + 1 :], i) for i, c in enumerate(w) if c == lost) if lost else [(w, -1)]
    return [(i, j) for i, word in enumerate(x) for rest in rests(word) for j in met.get(rest, ())]


def near_pairs(asking: list[str], homes: list[str], anagrams: int = 1 << 16):
    """Blocks (i, j) of near words asking[i], homes[j]; each list holds words of one length,
    those of ``homes`` as long or one letter longer. Groups of words with equal letters whose
    product is over ``anagrams`` are not compared word by word."""
    if not asking or not homes:
        return
    x, y = codes_of(asking), codes_of(homes)
    lost = 1 if x.shape[1] == y.shape[1] else 0
    same = _replaced if lost else _inserted
    (xv, xg, xn), (yv, yg, yn) = _groups(vectors_of(x)), _groups(vectors_of(y))
    xo, yo = np.argsort(xg, kind="stable"), np.argsort(yg, kind="stable")
    xs, ys = np.cumsum(xn) - xn, np.cumsum(yn) - yn
    for a, b in range_search(yv, xv, lost):
        product = xn[a] * yn[b]
        for k in np.flatnonzero(product > anagrams):
            left, right = xo[xs[a[k]] :][: xn[a[k]]], yo[ys[b[k]] :][: yn[b[k]]]
            change = yv[b[k]] - xv[a[k]]
            letter = lambda d: chr(d + 97 if d < 26 else d - 26 + 192)
            found = _by_rest([asking[i] for i in left], [homes[j] for j in right],
                             letter(int(np.argmin(change))) if lost else None, letter(int(np.argmax(change))))
            if found:
                i, j = np.array(found).T
                yield left[i], right[j]
        few = product <= anagrams
        a, b, product = a[few], b[few], product[few]
        ends, start = np.cumsum(product), 0
        while start < len(product):  # as many pairs of groups as fit in a block, one at least
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + _BLOCK, side="right")))
            pair = np.repeat(np.arange(start, stop), product[start:stop])
            k = np.arange(done, ends[stop - 1]) - (ends - product)[pair]
            high, low = np.divmod(k, yn[b[pair]])
            i, j = xo[xs[a[pair]] + high], yo[ys[b[pair]] + low]
            near = same(x[i], y[j])
            yield i[near], j[near]
            start = stop


def _best(words: list[str], n: np.ndarray) -> np.ndarray:
    """Rank of each word: most frequent first, then code-point order."""
    order = np.array(sorted(range(len(words)), key=lambda k: (-n[k], words[k])), np.int64)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    return rank


def _answer(frame: pd.DataFrame) -> pd.DataFrame:
    """One tile of a cell: for each word its near words there, counted, and the best one."""
    words, n = frame["word"].tolist(), frame["n"].to_numpy()
    asks = frame["asks"].to_numpy()
    size = frame["word"].str.len().to_numpy()
    rank = _best(words, n)
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words), np.int64)
    homes = np.flatnonzero(~asks)
    for length in np.unique(size[asks]) if len(homes) else ():
        askers = np.flatnonzero(asks & (size == length))
        for i, j in near_pairs([words[k] for k in askers], [words[k] for k in homes]):
            i, j = askers[i], homes[j]
            for one, other in ((i, j), (j, i)) if length < size[homes[0]] else ((i, j),):  # equal lengths ask both ways
                np.add.at(count, one, 1)
                np.minimum.at(best, one, rank[other])
    at = np.flatnonzero(count)
    by_rank = np.argsort(rank)
    other = by_rank[best[at]]
    return pd.DataFrame({"word": [words[k] for k in at], "n_near": count[at], "near": [words[k] for k in other], "near_n": n[other]}
                        ).astype({"word": object, "near": object})


def _blocks(batches, rows: int = 50_000):
    """Batches put together: what is done for each length and cell is done for many words at once."""
    held, n = [], 0
    for frame in batches:
        held.append(frame)
        n += len(frame)
        if n >= rows:
            yield pd.concat(held, ignore_index=True)
            held, n = [], 0
    if n:
        yield pd.concat(held, ignore_index=True)


def near_words(vocabulary: DataFrame, cell_words: int = 40_000) -> DataFrame:
    """(word, n_near, near, near_n) of the words that have near words; ``vocabulary`` is (word, n), distinct words."""
    spark = vocabulary.sparkSession
    sizes = {r["l"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("l")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    share = min(1.0, 0.95 * SAMPLE / max(total, 1))
    short = vocabulary.filter((F.length("word") <= 64) & (F.pmod(F.xxhash64("word", F.lit(11)), F.lit(1 << 30)) < int(share * (1 << 30))))
    sample = defaultdict(list)
    for r in short.select("word").limit(SAMPLE).collect():
        sample[len(r["word"])].append(r["word"])
    cells = []  # (length, low, high): at most MAX_CELLS and one for each length
    for length, n in sorted(sizes.items()):
        points = vectors_of(codes_of(sample[length])) if sample[length] else np.zeros((0, LETTERS), np.int16)
        most = max(1, MAX_CELLS * n // total)
        cells += [(length, low, high) for low, high in cell_boxes(points, n, cell_words, most)]
    of_length = defaultdict(list)
    for k, (length, low, high) in enumerate(cells):
        of_length[length].append((k, low, high))
    shared = spark.sparkContext.broadcast(dict(of_length))

    def deal(batches):
        for frame in _blocks(batches):
            length = frame["word"].str.len().to_numpy()
            for size in np.unique(length):
                part = frame[length == size]
                vectors = vectors_of(codes_of(part["word"].tolist()))
                out = []
                for cell, low, high in shared.value.get(size, ()):
                    gain, lose = _outside(vectors, low, high)
                    out += [(cell, False, gain + lose == 0), (cell, True, (gain <= 1) & (lose <= 1))]
                for cell, low, high in shared.value.get(size + 1, ()):
                    gain, lose = _outside(vectors, low, high)
                    out.append((cell, True, (gain <= 1) & (lose == 0)))
                yield pd.concat([part[at].assign(cell=cell, asks=asks) for cell, asks, at in out if at.any()])[["cell", "asks", "word", "n"]]

    dealt = save(vocabulary.select("word", "n").mapInPandas(deal, "cell int, asks boolean, word string, n long"), "cells")
    tiles = lambda asks: F.ceil(F.count_if(F.col("asks") == asks) / (cell_words * (4 if asks else 1))).cast("int")
    tiled = dealt.groupBy("cell").agg(F.greatest(tiles(False), F.lit(1)).alias("h"), F.greatest(tiles(True), F.lit(1)).alias("a"))
    # one row a cell, so broadcast: joined by cell, all tiles of a cell would stay in one task
    x = dealt.join(F.broadcast(tiled), "cell")
    tile = lambda count: F.pmod(F.xxhash64("word"), F.col(count)).cast("int")
    every = lambda count: F.sequence(F.lit(0), F.col(count) - 1)
    x = x.withColumn("i", F.explode(F.when(F.col("asks"), every("h")).otherwise(F.array(tile("h")))))
    x = x.withColumn("j", F.explode(F.when(F.col("asks"), F.array(tile("a"))).otherwise(every("a"))))
    found = x.groupBy("cell", "i", "j").applyInPandas(lambda key, frame: _answer(frame), "word string, n_near long, near string, near_n long")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.w").alias("near"), (-F.col("b.m")).alias("near_n"))


def roots_of(forms: DataFrame) -> DataFrame:
    """(word, root) for a table (word, form) of words that have a form, without circles: pointer
    doubling, so chains of length k take log2(k) steps."""
    now = save(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.filter("moved").isEmpty():
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = save(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return now.select("word", "root")


def variants(vocabulary: DataFrame, ratio: int = 2, cell_words: int = 40_000) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a written table (word, n): a word's form is its most
    frequent near word (ties: least in code-point order), if ``ratio`` times as frequent."""
    near = near_words(vocabulary, cell_words)
    x = vocabulary.join(near, "word", "left")
    fits = F.col("near_n") >= ratio * F.col("n")
    x = save(x.select("word", F.when(fits, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(fits, F.col("near_n")).alias("form_n")), "forms")
    roots = roots_of(x.filter("form is not null"))
    return x.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def spelling_variants(documents: DataFrame, typo_every: int | None = None, min_letters: int = 5, min_count: int = 3, ratio: int = 2,
                      cell_words: int = 40_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variants`` of the words of all texts that have ``min_letters`` and occur ``min_count`` times."""
    counts = word_counts(documents, typo_every, id_col, text_col)
    return variants(save(counts.filter((F.length("word") >= min_letters) & (F.col("n") >= min_count)), "vocabulary"), ratio, cell_words)
