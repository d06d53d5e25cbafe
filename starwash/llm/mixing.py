"""Mixing sources to target weights by systematic sampling.

A source's target is its weight's share of all sizes, but at most ``limit`` times
the source's own size; what is cut off is shared again by weight among the others
until no target is above its limit.

Every document of a source expects ``target / source size`` copies. Expected
copies are prefix-summed within the source, one random offset in [0, 1) is added
(the same in every run: a hash of the seed and the source), and a document is
taken once for each integer that its part of the sum crosses. So it gets the
expected number rounded down or up, at most ``limit`` times, and any stretch of
documents gets its expected copies but for less than one. Documents stand in
order of size, then id: as sizes only grow along the sum, the words taken differ
from the target by less than the source's largest document.

Prefix sums are positions in one global order times the source's rate
(``positions``), so a source with a third of all rows is spread over all tasks.
The table of sources stays in Spark too; limits are found by repeated sums over it.

Defined cases: null or empty texts have size 0 and take nothing; the null source
is a source of its own, the last; a source without words has target 0; rows that
share an id are rows of their own; rows with a null id come first among those of
equal size; an empty table gives no rows; input columns other than id, text and
source are not read, so they cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import save
from starwash.llm.positions import with_position

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def weighted(sources: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``weight`` by the source's place in code-point order (null last), the list repeating."""
    placed = with_position(sources, [F.col("source").asc_nulls_last()], "place")
    by_place = F.array(*[F.lit(float(w)) for w in weights])
    return placed.withColumn("weight", F.get(by_place, F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int"))).drop("place")


def targets(sources: DataFrame, share: float = 1.0, limit: float = 3.0) -> DataFrame:
    """(source, source_size, weight) with ``target``, in words."""
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    wanted, cap = share * total, limit * F.col("source_size")
    level, above, seen = 0.0, F.lit(False), -1
    while True:  # the level only rises, so sources that have met their limit stay there
        at_limit, weight, n = sources.agg(
            F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count_if(above)).first()
        if n == seen or not weight:
            break
        seen, level = n, (wanted - at_limit) / weight
        above = F.col("weight") * level > cap
    return sources.withColumn("target", F.when(above, cap).otherwise(F.col("weight") * level))


def _offset(seed: int) -> Column:
    """One number in [0, 1) for each source: the first 32 bits of sha256(seed:source)."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col("source"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double") / 4294967296.0


def mix(documents: DataFrame, weights: Sequence[float], share: float = 1.0, limit: float = 3.0, seed: int = 13,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for every row."""
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
                            word_count(F.col(text_col).cast("string")).alias("size"))
    rows = save(rows, "sizes")
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = save(targets(save(weighted(sources, weights), "sources"), share, limit), "targets")
    placed = save(with_position(rows, [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id")]), "positions")
    # the prefix sum starts anew in each source
    first = placed.groupBy("source").agg((F.min("position") - 1).alias("before")).withColumnRenamed("source", "_s")
    sources = sources.join(first, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").withColumnRenamed("source", "_s")
    x = placed.join(sources, F.col("source").eqNullSafe(F.col("_s")), "left")
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size").cast("double")), F.lit(0.0))
    x = x.withColumn("_rate", rate).withColumn("_whole", F.floor("_rate")).withColumn("_at", F.col("position") - F.col("before"))
    part, u = F.col("_rate") - F.col("_whole"), _offset(seed)
    crossed = F.floor(part * F.col("_at") + u) - F.floor(part * (F.col("_at") - 1) + u)
    return x.select("doc_id", "source", "size", "source_size", "target", (F.col("_whole") + crossed).cast("long").alias("copies"))


def emit(documents: DataFrame, plan: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix itself: each row of ``documents`` (its ids unique) as often as ``plan`` takes it, with ``copy_no``."""
    copies = plan.filter("copies > 0").select(F.col("doc_id").alias("_id"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy_no"))
    return documents.drop("copy_no").join(copies, F.col(id_col) == F.col("_id")).drop("_id")
