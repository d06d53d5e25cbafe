"""Entity resolution: exact match, then blocked fuzzy match (OP3, JN1-5, WIN2, SET1).

Resolution runs on distinct vehicles, not on registrations: a vehicle is the
tuple (VEHICLE_ID, model_name, variant, MAKE_YEAR_KEY), and everything the
reference decides per registration depends only on that tuple. The map is
joined back to registrations by the tuple (null-safe on the model).

The fuzzy step finds every dimension row in the same block and year within
Levenshtein distance ``t`` without forming all pairs in a block, also where the
names of a model line share most of their letters:

1. Partition filter (Pass-Join; Li, Deng, Wang, Feng; VLDB 2011), k of n: a text is
   cut into n = t + k segments. t edits touch t of them at most, so a text within
   distance t holds k unchanged, near their old places. Hence it holds at least one
   of *any* t + 1 of them, and the t + 1 rarest are enough: segments that many texts
   share (a common model name) are signatures of none.
2. Each text takes the cut (long segments, thirds or pairs of letters) whose t + 1
   rarest segments are the rarest in sum, counted over all texts.
3. Distinct texts are joined by signature; ``levenshtein(a, b, t)`` is a condition of
   that join, so it emits pairs within the distance only. Rows follow afterwards.

A signature that stays frequent is split by the skew handling of its join.

Joins with the dimension and of rows that an explode made are merge joins by hint: Spark
estimates them by the bytes of their files, before any explode, and would broadcast
them through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import rules as R

VEHICLE = ("VEHICLE_ID", "model_name", "variant", "MAKE_YEAR_KEY")


def _segments(length: Column, n: Column, i: Column):
    """Start (0-based) and length of segment ``i`` when a string of ``length``
    is cut into ``n`` parts, the longer parts last."""
    base = F.floor(length / n).cast("int")
    longer = (length % n).cast("int")
    shorter = n - longer
    seg_len = base + F.when(i >= shorter, 1).otherwise(0)
    start = i * base + F.greatest(i - shorter, F.lit(0))
    return start, seg_len


def _cuts(length: Column, t: int) -> Column:
    """Numbers of segments that a text of this length may be cut into."""
    least = F.lit(t + 1)
    return F.array_distinct(F.array(least, *[F.greatest(least, F.ceil(length / size).cast("int")) for size in (3, 2)]))


def _signature(keys: Sequence[str], segment: Column) -> Column:
    return F.xxhash64(*keys, "_len", "_n", "_i", segment)


def index_signatures(texts: DataFrame, keys: Sequence[str], text: str, t: int) -> DataFrame:
    """``t`` + 1 rows (``_sig``) for each distinct text: the rarest segments of its best cut."""
    x = texts.withColumn("_len", F.length(text)).withColumn("_n", F.explode(_cuts(F.col("_len"), t)))
    x = x.withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    start, size = _segments(F.col("_len"), F.col("_n"), F.col("_i"))
    x = x.select(*keys, text, "_n", "_i", _signature(keys, F.col(text).substr(start + 1, size)).alias("_sig"))
    x = x.hint("merge").join(x.groupBy("_sig").agg(F.count(F.lit(1)).alias("_f")).hint("merge"), "_sig")
    x = x.groupBy(*keys, text).agg(F.collect_list(F.struct("_n", "_f", "_i", "_sig")).alias("_all"))

    def rarest(n):
        chosen = F.slice(F.array_sort(F.filter("_all", lambda s: s["_n"] == n)), 1, t + 1)
        return F.struct(F.aggregate(chosen, F.lit(0).cast("long"), lambda a, s: a + s["_f"]).alias("cost"), n.alias("n"),
                        F.transform(chosen, lambda s: s["_sig"]).alias("sigs"))

    best = F.array_min(F.transform(F.array_distinct(F.transform("_all", lambda s: s["_n"])), rarest))
    return x.select(*keys, text, F.explode(best["sigs"]).alias("_sig"))


def probe_signatures(texts: DataFrame, keys: Sequence[str], text: str, t: int) -> DataFrame:
    """Every signature that a string within distance ``t`` of a distinct text could have."""
    plen = F.length(text)
    x = texts.withColumn("_plen", plen).withColumn("_len", F.explode(F.sequence(F.greatest(plen - t, F.lit(0)), plen + t)))
    x = x.withColumn("_n", F.explode(_cuts(F.col("_len"), t))).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    start, size = _segments(F.col("_len"), F.col("_n"), F.col("_i"))
    x = x.withColumn("_start", start).withColumn("_size", size)
    # a shift s takes |s| edits before the segment and |d - s| after it, for a length gap of d: t at most
    gap = F.col("_plen") - F.col("_len")
    low = F.greatest(F.col("_start") - F.floor((F.lit(t) - gap) / 2), F.lit(0))
    high = F.least(F.col("_start") + F.floor((F.lit(t) + gap) / 2), F.col("_plen") - F.col("_size"))
    places = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    x = x.withColumn("_at", F.explode(places))
    return x.select(*keys, text, _signature(keys, F.col(text).substr(F.col("_at") + 1, F.col("_size"))).alias("_sig"))


def _distinct_texts(df: DataFrame, text: str, keys: Sequence[str], block: str | None, name: str, key_names: Sequence[str]) -> DataFrame:
    """``df`` with its keys as ``key_names`` and its text, without the block it begins with, as ``name``."""
    whole = F.col(text)
    rest = whole.substr(F.length(F.col(block)) + 1, F.length(whole)) if block else whole
    return df.withColumns({**{k: F.col(c) for k, c in zip(key_names, keys)}, name: rest})


def text_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], t: int, verified: bool = True) -> DataFrame:
    """(keys, ``_a``, ``_b``), once for each common signature: distinct texts ``_a`` of ``left`` and
    ``_b`` of ``right``, equal on ``keys``, within distance ``t``. Without ``verified`` the distance is
    not asked for, which shows what the join compares."""
    known = [F.col(k).isNotNull() for k in keys]
    distinct = lambda df, text: df.filter(reduce(and_, known, F.col(text).isNotNull())).select(*keys, text).distinct()
    probes = probe_signatures(distinct(left, "_a"), keys, "_a", t).alias("p")
    index = index_signatures(distinct(right, "_b"), keys, "_b", t).alias("i")
    same = [F.col("p._sig") == F.col("i._sig"), *[F.col(f"p.{k}") == F.col(f"i.{k}") for k in keys]]
    if verified:
        same.append(F.levenshtein(F.col("_a"), F.col("_b"), t) >= 0)
    return probes.hint("merge").join(index.hint("merge"), same, "inner").select(*[F.col(f"p.{k}").alias(k) for k in keys], "_a", "_b")


def similar_pairs(left: DataFrame, right: DataFrame, *, left_text: str, right_text: str,
                  keys: Sequence[tuple[str, str]], threshold: int = R.DEFAULT_FUZZY_THRESHOLD,
                  dist_col: str = "LEV_DIST", prefix: tuple[str, str] | None = None) -> DataFrame:
    """All pairs of rows equal on ``keys`` with ``levenshtein(left_text, right_text) <= threshold``.

    Column names of ``left`` and ``right`` must not overlap. ``prefix`` names a pair of
    ``keys`` whose values begin both texts (a prefix block): that part is the same on
    both sides and does not change the distance, so it is left out of the segments.
    Rows with a null text or key have no pairs.
    """
    t = int(threshold)
    lblock, rblock = prefix or (None, None)
    names = [f"_k{i}" for i in range(len(keys))]
    lrows = _distinct_texts(left, left_text, [a for a, _ in keys], lblock, "_a", names)
    rrows = _distinct_texts(right, right_text, [b for _, b in keys], rblock, "_b", names)
    pairs = text_pairs(lrows, rrows, names, t).distinct()
    pairs = pairs.withColumn(dist_col, F.levenshtein(F.col("_a"), F.col("_b"), t))
    pairs = lrows.hint("merge").join(pairs.hint("merge"), [*names, "_a"]).hint("merge")
    return pairs.join(rrows.hint("merge"), [*names, "_b"]).select(*left.columns, *right.columns, dist_col)


def best_match(pairs: DataFrame, left_id: Sequence[str], right_id: str, dist_col: str = "LEV_DIST") -> DataFrame:
    """Closest right row per left row; ties go to the smallest right id."""
    best = F.min(F.struct(F.col(dist_col).alias("d"), F.col(right_id).alias("r")))
    return pairs.groupBy(*left_id).agg(best.alias("_b")).select(
        *left_id, F.col("_b.r").alias(right_id), F.col("_b.d").alias(dist_col)
    )


def natural_key(model, variant, year) -> Column:
    """The normalised (model, variant, year) of a vehicle; null if any part is."""
    parts = F.array(X.norm(model), X.norm(variant), X.c(year))
    return F.when(F.forall(parts, lambda p: p.isNotNull()), parts)


def resolve_vehicles(staged: DataFrame, dim_vehicle: DataFrame, threshold: int = R.DEFAULT_FUZZY_THRESHOLD,
                     block_length: int = R.BLOCK_KEY_LENGTH) -> DataFrame:
    """Vehicle-level resolution map.

    Columns: the vehicle tuple, VEHICLE_ID_resolved, LEV_DIST (null for exact),
    IS_FUZZY_MATCH. A vehicle with no exact and no fuzzy match is absent; one
    matching several dimension rows exactly gets one row per match. Fuzzy
    matches are looked for among rows of the same year whose first
    ``block_length`` characters agree.
    """
    vehicles = staged.select(*VEHICLE).distinct().withColumn("_key", natural_key("model_name", "variant", "MAKE_YEAR_KEY"))
    known = dim_vehicle.select(F.col("VEHICLE_ID").alias("VEHICLE_ID_resolved"), F.col("MAKE_YEAR").alias("_year"),
                               X.norm("MODEL_NAME").alias("_model"), X.norm("VARIANT").alias("_variant"))
    keyed = known.select("VEHICLE_ID_resolved", natural_key("_model", "_variant", "_year").alias("_key"))
    exact = vehicles.hint("merge").join(keyed.hint("merge"), "_key")
    unresolved = vehicles.hint("merge").join(exact.select("_key").distinct().hint("merge"), "_key", "left_anti").select(*VEHICLE)

    probes = unresolved.withColumn("_text", X.fuzzy_key("model_name", "variant"))
    probes = probes.withColumn("_block", F.substring("_text", 1, block_length))
    index = known.select("VEHICLE_ID_resolved", "_year", X.fuzzy_key("_model", "_variant").alias("_known_text"),
                         F.substring("_model", 1, block_length).alias("_known_block"))
    block = ("_block", "_known_block")
    pairs = similar_pairs(probes, index, left_text="_text", right_text="_known_text", threshold=threshold,
                          keys=[block, ("MAKE_YEAR_KEY", "_year")], prefix=block)
    fuzzy = best_match(pairs, VEHICLE, "VEHICLE_ID_resolved")
    return (exact.select(*VEHICLE, "VEHICLE_ID_resolved", F.lit(None).cast("int").alias("LEV_DIST"))
            .unionByName(fuzzy).withColumn("IS_FUZZY_MATCH", F.col("LEV_DIST").isNotNull()))


def vehicle_join_condition(left: str, right: str) -> Column:
    """Equality of the vehicle tuple between two aliased frames (null-safe model)."""
    l, r = (lambda c: F.col(f"{left}.{c}")), (lambda c: F.col(f"{right}.{c}"))
    return (
        (l("VEHICLE_ID") == r("VEHICLE_ID"))
        & l("model_name").eqNullSafe(r("model_name"))
        & (l("variant") == r("variant"))
        & (l("MAKE_YEAR_KEY") == r("MAKE_YEAR_KEY"))
    )


def registration_map(staged: DataFrame, vehicle_map: DataFrame, key: str = "reg_no") -> DataFrame:
    """The per-registration map: key, VEHICLE_ID_resolved, LEV_DIST, IS_FUZZY_MATCH."""
    rows = staged.select(key, *VEHICLE).alias("r")
    return rows.join(vehicle_map.alias("vm"), vehicle_join_condition("r", "vm"), "inner").select(
        F.col(f"r.{key}").alias(key),
        F.col("vm.VEHICLE_ID_resolved"),
        F.col("vm.LEV_DIST"),
        F.col("vm.IS_FUZZY_MATCH"),
    )
