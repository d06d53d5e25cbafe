"""Data-quality checks (DQ1-9, AGG5-7) as one-row summary frames.

Each check is a single aggregate (map-side combined), or an anti join for
referential integrity. Results are ``checked`` / ``failed`` counts so they can
be stored per run and compared across runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import rules as R


def dataset_count(df: DataFrame, name: str = "") -> int:
    """AGG7: the row count of a frame (one job), logged under ``name``."""
    import logging

    n = df.count()
    logging.getLogger("starwash").info("rows in %s: %d", name or "frame", n)
    return n


def count_if(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def prepost_metrics(before: DataFrame, after: DataFrame, maker: str = "maker_name",
                    parsed: str = "from_date_parsed", kind: str = "misalignment_type") -> DataFrame:
    """DQ1/AGG6/AGG7: row counts and null counts before and after, one row per stage."""
    pre = before.agg(
        F.count(F.lit(1)).alias("total_rows"), count_if(F.col(maker).isNull()).alias("null_maker")
    ).withColumn("stage", F.lit("pre"))
    post = after.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(F.col(maker).isNull()).alias("null_maker"),
        count_if(F.col(parsed).isNotNull()).alias("valid_dates"),
        count_if(F.col(kind) != R.MISALIGN_CLEAN).alias("misaligned_rows"),
    ).withColumn("stage", F.lit("post"))
    return pre.unionByName(post, allowMissingColumns=True)


def misalignment_summary(classified: DataFrame, kind: str = "misalignment_type") -> DataFrame:
    """DQ2: rows per misalignment class and the misaligned share in percent."""
    k = F.col(kind)
    return classified.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_if(k == R.MISALIGN_TYPE1).alias("type1_rows"),
        count_if(k == R.MISALIGN_TYPE2).alias("type2_rows"),
        count_if(k == R.MISALIGN_TYPE3).alias("type3_rows"),
        count_if(k == R.MISALIGN_CLEAN).alias("clean_rows"),
    ).withColumn(
        "misaligned_pct",
        F.lit(100.0) * (F.col("total_rows") - F.col("clean_rows")) / F.col("total_rows"),
    )


def key_determinism(df: DataFrame, natural_key: Sequence[Column], surrogate: str) -> DataFrame:
    """DQ3: natural keys that map to more than one surrogate id."""
    per_key = df.groupBy(*natural_key).agg(F.count_distinct(F.col(surrogate)).alias("_n"))
    return per_key.agg(F.count(F.lit(1)).alias("checked"), count_if(F.col("_n") > 1).alias("failed"))


def vehicle_key_determinism(staged: DataFrame) -> DataFrame:
    nk = [X.norm("model_name").alias("_m"), X.norm("variant").alias("_v"), F.col("MAKE_YEAR_KEY").alias("_y")]
    return key_determinism(staged, nk, "VEHICLE_ID")


def unique_not_null(dim: DataFrame, key: str) -> DataFrame:
    """DQ4: ids that repeat, and null ids."""
    per_id = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_id.agg(
        F.sum("_n").alias("checked"),
        count_if(F.col("_n") > 1).alias("duplicated_ids"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_n"))), F.lit(0)).alias("null_ids"),
    )


def value_domain(df: DataFrame, column: str, domain: Sequence[str] = R.EMISSION_DOMAIN) -> DataFrame:
    """DQ5: values outside an allowed set (null counts as outside, as ``~isin`` drops it)."""
    return df.agg(
        F.count(F.lit(1)).alias("checked"),
        count_if(~F.col(column).isin(list(domain))).alias("failed"),
    )


def distance_within(resolution: DataFrame, threshold: int = R.DEFAULT_FUZZY_THRESHOLD) -> DataFrame:
    """DQ6: fuzzy matches above the distance threshold."""
    return resolution.agg(
        count_if(F.col("IS_FUZZY_MATCH")).alias("checked"),
        count_if(F.col("IS_FUZZY_MATCH") & (F.col("LEV_DIST") > threshold)).alias("failed"),
    )


def mandatory_keys(fact: DataFrame, keys: Sequence[str] = ("VEHICLE_ID", "RTA_ID")) -> DataFrame:
    """DQ7: fact rows missing a mandatory foreign key."""
    missing = None
    for k in keys:
        missing = F.col(k).isNull() if missing is None else (missing | F.col(k).isNull())
    return fact.agg(F.count(F.lit(1)).alias("checked"), count_if(missing).alias("failed"))


def date_key_format(fact: DataFrame, column: str = "REGISTRATION_ISSUE_DATE_ID") -> DataFrame:
    """DQ8: date ids whose text is not 8 digits long (a null id is not)."""
    ok = F.coalesce(F.length(F.col(column).cast("string")) == 8, F.lit(False))
    return fact.agg(F.count(F.lit(1)).alias("checked"), count_if(~ok).alias("failed"))


def orphans(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """DQ9: fact rows whose key has no dimension row (a null key is an orphan).

    Fact rows are first counted per key (map-side combined), so a hot key is
    one row before the join to the dimension keys.
    """
    per_key = fact.groupBy(F.col(key).alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
    d = dim.select(F.col(dim_key or key).alias("_dk")).distinct().withColumn("_hit", F.lit(True))
    return (
        per_key.join(d, F.col("_fk") == F.col("_dk"), "left")
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("checked"),
             F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0)).cast("long").alias("failed"))
        .select(F.lit(key).alias("foreign_key"), "checked", "failed")
    )


def referential_integrity(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """DQ9 for several foreign keys: one row per key."""
    out = None
    for key, dim in dims.items():
        part = orphans(fact, dim, key)
        out = part if out is None else out.unionByName(part)
    return out
