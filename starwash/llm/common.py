"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starwash.session import work_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends
    there, so a lost executor costs one task of the reader, not the chain."""
    spark = df.sparkSession
    path = work_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows of an Arrow batch, so that a batch of very long texts
    still fits in a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def id_fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def sample_by_id(df: DataFrame, id_col: str, rows: int, seed: int, total: int) -> DataFrame:
    """A hash sample of about 95 % of ``rows`` (all rows if there are no more
    than that), the same in every run; the limit holds the bound if chance, or
    one id on many rows, would pass it."""
    share = 1.0 if total <= rows else 0.95 * rows / total
    pick = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) < int(share * (1 << 30))
    return df.filter(pick).limit(rows)


def rows_with_ids(rows: DataFrame, ids: DataFrame, id_col: str, max_bits: int = 1 << 29) -> DataFrame:
    """``rows`` whose ``id_col`` (long) is in ``ids`` (one column of that name).

    A bitmap of 16 bits an id, at places given by hashes, is broadcast and drops most
    other rows (all but 6 %) where they are read; the rest meet the ids in a join. So
    what is shuffled is about the wanted rows, not the table. Beyond ``max_bits``
    (64 MB; 30 million ids) the join alone decides: the result is the same."""
    ids = ids.select(F.col(id_col).alias("_id")).distinct()
    bits = 1 << 15
    n = ids.count()
    while bits < 16 * n:
        bits *= 2
    if bits <= max_bits:
        place = lambda x: F.pmod(F.xxhash64(x, F.lit(5)), F.lit(bits))
        maps = ids.select(place("_id").alias("p")).select((F.col("p") / F.lit(1 << 15)).cast("int").alias("_bucket"), (F.col("p") % (1 << 15)).alias("p"))
        maps = maps.groupBy("_bucket").agg(F.bitmap_construct_agg("p").alias("_bits"))
        at = place(id_col) % (1 << 15)
        byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        near = rows.join(F.broadcast(maps), (place(id_col) / F.lit(1 << 15)).cast("int") == F.col("_bucket"))
        rows = near.filter(F.getbit(byte, (at % 8).cast("int")) == 1).select(*rows.columns)
    # the ids are distinct, so this is a semi join; written as one, the optimizer moves it below the bitmap, and all rows are shuffled
    return rows.join(ids.withColumnRenamed("_id", id_col), id_col).select(*rows.columns)
