"""MinHash near-dedup with HyperMinHash sketches.

A document's set is its distinct ``shingle``-word shingles (64-bit hashes). Its
sketch has ``REGISTERS`` registers: shingles are dealt to registers by hash bits,
and a register stores, of its least hash, the count of leading zeros (6 bits)
and the next 10 bits (the mantissa): 16 bits instead of 64. Empty registers of
small sets are filled from other registers in a fixed order per register
(optimal densification), so a register of two sets agrees with a probability
near their Jaccard similarity J whatever the size of the sets.

Candidates: four registers make one 64-bit band key, 32 keys a document. A pair
at J = 0.75 shares no key with probability (1 - 0.75^4)^32 = 5e-6.

1. Equal sets are one class, known by a 128-bit digest; only the class's
   least id, its node, goes on. A group of exact copies costs one row.
2. Hubs: in each bucket (equal band key) every node is paired with the bucket's
   most central node (the one that meets most others over all its buckets),
   not with all others: a bucket of m nodes makes m - 1 pairs.
3. Pairs pass the exact length filter, then the sketch's estimate of J,
   corrected for register collisions, then the exact test on the full sets.
   Connected components follow from the confirmed links.
4. Rest: buckets that still hold several components are joined with themselves,
   only across components and only pairs not tested yet. Conditions of that join
   bound what it emits: the length filter; an exact bound of the overlap (a shingle
   that one component alone has cannot be shared across, so two nodes share no more
   than the lesser number of their other shingles); the sketch estimate; and the
   overlap of the sets themselves, for large ones of their ``LEAST`` least hashes.
   So copies of one text that are edited to just below the threshold are compared
   inside the join and emit nothing. Large buckets are split over ``tiles`` x
   ``tiles`` tasks. What passes is tested on the full sets, and components are taken again.

So hubs connect large groups in linear work, and step 4 leaves no candidate
pair between different components untested.

Defined cases: null, empty and wordless texts have an empty set, size 0, and
are linked with nothing; fewer words than ``shingle`` make one shingle of the
whole sequence; rows that share an id are one document; rows with a null id
are not linked (null component, kept); further columns are not returned.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import rows_with_ids, save, small_batches
from starwash.llm.components import components

REGISTERS, BAND = 128, 4
_MANTISSA = 10
LEAST = 512
_CACHE: dict[bytes, int] = {}
_CACHE_WORDS = 200_000  # words whose hashes a Python worker remembers; only speed depends on it


def shingle_hashes(text: str | None, shingle: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles. Words are
    maximal runs without ASCII white space, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(_CACHE) > _CACHE_WORDS:
        _CACHE.clear()
    for w in set(words).difference(_CACHE):
        _CACHE[w] = xxhash.xxh3_64_intdigest(w)
    h = np.array([_CACHE[w] for w in words], dtype=np.uint64)
    n = min(shingle, len(h))
    with np.errstate(over="ignore"):
        mixed = np.full(len(h) - n + 1, n, np.uint64)
        for j in range(n):
            mixed = (mixed ^ h[j : len(h) - n + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


@lru_cache(maxsize=1)
def _donors() -> np.ndarray:
    """Row r: the order in which an empty register r looks at the others."""
    return np.stack([np.random.default_rng(1000 + r).permutation(REGISTERS) for r in range(REGISTERS)])


def registers(hashes: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (uint16) of sorted distinct hashes, not empty."""
    bits = REGISTERS.bit_length() - 1
    bucket = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])  # sorted: the least hash of each bucket
    rest = hashes[first] << np.uint64(bits)
    # leading zeros from the exponent of the top 53 bits, mantissa: the bits after the first one
    zeros = np.where(rest == 0, 63, 64 - np.frexp((rest >> np.uint64(11)).astype(float))[1] - 11)
    zeros = np.minimum(zeros, 63).astype(np.uint64)
    mantissa = (rest << zeros << np.uint64(1)) >> np.uint64(64 - _MANTISSA)
    out, full = np.zeros(REGISTERS, np.uint16), np.zeros(REGISTERS, bool)
    out[bucket[first]] = (zeros << np.uint64(_MANTISSA) | mantissa).astype(np.uint16)
    full[bucket[first]] = True
    if not full.all():
        order = _donors()
        donor = order[np.arange(REGISTERS), np.argmax(full[order], axis=1)]
        out = np.where(full, out, out[donor])
    return out


def collision_rate() -> float:
    """Chance that registers of different least hashes agree, for sets of like
    size (the length filter sees to that): the limit 0.16992 * 2^(1 - mantissa bits)."""
    return 0.169919487159739 * 2.0 ** (1 - _MANTISSA)


def estimate_jaccard(equal_registers, n_registers: int = REGISTERS):
    c = collision_rate()
    return (equal_registers / n_registers - c) / (1 - c)


def sketch(documents: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bands): digest of the set and its band keys
    (null for an empty set)."""
    small_batches(documents.sparkSession)

    def run(batches):
        for frame in batches:
            rows = []
            for doc, text in zip(frame["i"], frame["t"]):
                h = shingle_hashes(text if isinstance(text, str) else None, shingle)
                if len(h):
                    digest = xxhash.xxh3_128_digest(h.tobytes())
                    d1, d2 = np.frombuffer(digest, np.int64)
                    rows.append((doc, len(h), int(d1), int(d2), registers(h).view(np.int64)))
                else:
                    rows.append((doc, 0, None, None, None))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "d1", "d2", "bands"])
            yield out.astype({"doc_id": "Int64", "d1": "Int64", "d2": "Int64"})

    return documents.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).mapInPandas(
        run, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>")


def _equal_registers(x, y):
    """Equal 16-bit lanes of two arrays of band keys."""
    def lanes(u, v):
        z = u.bitwiseXOR(v)
        return sum(((F.shiftrightunsigned(z, s).bitwiseAND(F.lit(0xFFFF))) == 0).cast("int") for s in (0, 16, 32, 48))

    return F.aggregate(F.zip_with(x, y, lanes), F.lit(0), lambda a, b: a + b)


def _alike(a: str, b: str, percent: int, slack: float):
    """The length filter (exact) and the sketch estimate (``slack`` below the
    threshold: 6 standard deviations of 128 registers)."""
    n1, n2 = F.col(f"{a}n"), F.col(f"{b}n")
    return ((100 * F.least(n1, n2) >= percent * F.greatest(n1, n2))
            & (estimate_jaccard(_equal_registers(F.col(f"{a}bands"), F.col(f"{b}bands"))) >= percent / 100 - slack))


def confirm(pairs: DataFrame, documents: DataFrame, percent: int, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Pairs (a, b) of ids whose full sets meet 100 * intersection >= percent * union."""
    small_batches(documents.sparkSession, 128)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("i")).distinct()

    def sets(batches):
        for frame in batches:
            values = [shingle_hashes(t if isinstance(t, str) else None, shingle).tobytes() for t in frame["t"]]
            yield pd.DataFrame({"i": frame["i"], "s": values})

    texts = documents.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    full = save(rows_with_ids(texts, ids, "i").mapInPandas(sets, "i long, s binary"), "sets")

    @F.pandas_udf("boolean")
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            u, v = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            at = np.searchsorted(u, v)
            both = int((u[np.minimum(at, len(u) - 1)] == v).sum()) if len(u) else 0
            out.append(100 * both >= percent * (len(u) + len(v) - both))
        return pd.Series(out, dtype=bool)

    side = lambda c: full.select(F.col("i").alias(c), F.col("s").alias(f"{c}s"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").filter(linked("as", "bs"))
            .select("a", "b").distinct())


def shareable(nodes: DataFrame, documents: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(node, u, least) for the given (node, c): how many shingles of each node a node of another
    component has, too, and the first 31 bits of the node's ``LEAST`` least shingle hashes (of all, if it has no more)."""
    small_batches(documents.sparkSession, 128)

    def run(batches):
        for frame in batches:
            hashes = [(shingle_hashes(t if isinstance(t, str) else None, shingle) >> np.uint64(1)).view(np.int64) for t in frame["t"]]
            yield pd.DataFrame({"node": frame["i"], "c": frame["c"], "s": hashes})

    texts = documents.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"))
    here = nodes.select(F.col("node").alias("i"), "c")
    sets = save(rows_with_ids(texts, here.select("i"), "i").join(here, "i").mapInPandas(run, "node long, c long, s array<long>"), "mixed-sets")
    each = sets.select("node", "c", F.explode("s").alias("s"))
    # counted where they are read, so a shingle of many nodes costs one row a task
    across = each.groupBy("s").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 != c2").select("s")
    shared = each.join(across, "s").groupBy("node").agg(F.count_distinct("s").alias("u"))
    least = sets.select("node", F.transform(F.slice("s", 1, LEAST), lambda h: F.shiftright(h, 32).cast("int")).alias("least")).distinct()
    return least.join(shared, "node")


def _first_meeting(a: str, b: str):
    """Two nodes may share many buckets, all of them mixed if one is: the pair is looked at in the first."""
    before = [F.slice(f"{x}bands", F.lit(1), F.col("k")) for x in (a, b)]
    return ~F.exists(F.zip_with(*before, lambda x, y: x == y), lambda same: same)


def _overlap_fits(a: str, b: str, percent: int):
    """Sets of at most ``LEAST`` shingles: the exact test, but for two shingles that a set may have lost where
    31 bits agree. Larger ones: the share of common hashes among those up to the lower end of both lists is not
    6 standard deviations below the threshold."""
    x, y, n1, n2 = F.col(f"{a}least"), F.col(f"{b}least"), F.col(f"{a}n"), F.col(f"{b}n")
    whole = (n1 <= LEAST) & (n2 <= LEAST)
    exact = (100 + percent) * (F.size(F.array_intersect(x, y)) + 2) >= percent * (n1 + n2)
    end = F.least(*[F.when(n > LEAST, F.element_at(v, -1)).otherwise(F.lit((1 << 31) - 1)) for v, n in ((x, n1), (y, n2))])
    low = [F.filter(v, lambda h: h <= end) for v in (x, y)]
    both = F.size(F.array_intersect(*low))
    slack = 6 * (percent * (100 - percent) / 10_000 / LEAST) ** 0.5
    return F.when(whole, exact).otherwise(both >= (percent / 100 - slack) * (F.size(low[0]) + F.size(low[1]) - both))


def near_duplicates(documents: DataFrame, percent: int = 75, shingle: int = 5, slack: float = 0.23, tiles: int = 16,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``."""
    sketches = save(sketch(documents, shingle, id_col, text_col), "sketch")
    some = sketches.filter("d1 is not null and doc_id is not null")
    classes = some.groupBy("d1", "d2").agg(F.min("doc_id").alias("node"))
    members = some.join(classes, ["d1", "d2"])
    # a node may stand for several sets (rows that share an id): their order does not matter
    nodes = save(members.filter("doc_id = node").select("node", F.col("n_shingles").alias("n"), "bands").distinct(), "nodes")

    band = nodes.select("node", F.posexplode("bands").alias("k", "key"))
    band = band.select("node", "k", F.xxhash64("k", "key").alias("key"))
    shared = band.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = save(band.join(shared, "key"), "buckets")
    central = buckets.groupBy("node").agg(F.sum("size").alias("met"))
    hubs = buckets.join(central, "node").groupBy("key").agg(F.max_by("node", "met").alias("hub"))
    first = (buckets.join(hubs, "key").filter("node != hub")
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"{c}n"), F.col("bands").alias(f"{c}bands"))
    first = save(first.join(side("a"), "a").join(side("b"), "b").filter(_alike("a", "b", percent, slack))
                 .select("a", "b").distinct(), "hub-pairs")
    links = save(confirm(first, documents, percent, shingle, id_col, text_col), "hub-links")
    # rows that share an id share the document: all its classes are linked
    same = members.filter("doc_id != node").select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()
    same = same.join(nodes.select(F.col("node").alias("a")), "a", "left_semi")
    links = links.unionByName(same)
    found = components(links, "hub-components")

    # what hubs left apart: buckets that still hold several components
    of = F.coalesce("component", "node")
    apart = buckets.join(found, "node", "left").select("key", "k", "node", "size", of.alias("c"))
    mixed = apart.groupBy("key").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 != c2").select("key")
    apart = save(apart.join(mixed, "key"), "mixed")
    here = apart.select("node", "c").distinct()
    # a node that shares less than its part of the threshold has no link across
    apart = apart.join(nodes, "node").join(save(shareable(here, documents, shingle, id_col, text_col), "shareable"), "node")
    apart = apart.filter(100 * F.col("u") >= percent * F.col("n"))
    split = F.when(F.col("size") > 64 * tiles, tiles).otherwise(1)
    tile = F.pmod(F.xxhash64("node"), split).cast("int")
    every = F.sequence(F.lit(0), (split - 1).cast("int"))
    left = apart.select("key", "k", F.col("c").alias("ac"), F.col("node").alias("a"), F.col("n").alias("an"), F.col("u").alias("au"), F.col("bands").alias("abands"), F.col("least").alias("aleast"),
                        tile.alias("i"), F.explode(every).alias("j"))
    right = apart.select("key", F.col("c").alias("bc"), F.col("node").alias("b"), F.col("n").alias("bn"), F.col("u").alias("bu"), F.col("bands").alias("bbands"), F.col("least").alias("bleast"),
                         F.explode(every).alias("i"), tile.alias("j"))
    rest = (left.join(right, (left["key"] == right["key"]) & (left["i"] == right["i"]) & (left["j"] == right["j"])
                      & (left["ac"] < right["bc"]) & ((100 + percent) * F.least("au", "bu") >= percent * (F.col("an") + F.col("bn")))
                      & _first_meeting("a", "b") & _alike("a", "b", percent, slack) & _overlap_fits("a", "b", percent))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    rest = save(rest.join(first, ["a", "b"], "left_anti"), "rest-pairs")
    if not rest.isEmpty():
        more = confirm(rest, documents, percent, shingle, id_col, text_col)
        found = components(links.unionByName(more), "components")

    least = members.join(found, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    return sketches.join(least, "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
