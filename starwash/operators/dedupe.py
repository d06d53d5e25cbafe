"""Keep one row per key under a stated total order (WIN1, FLT3, AGG5, JN3).

The kept rows alone are a ``row_number() = 1`` window: Catalyst plans it with a
partial ``WindowGroupLimit`` before the shuffle, so a key that holds a third of
all rows still sends at most one row per map partition across the network.

Where the removed rows are wanted too, every row is ranked in two windows over
one scan, always by the same plan:

1. rows are ranked within (key, bucket). The bucket is a hash of the row and its
   input partition, so neither a hot key nor a flood of identical rows shares
   one. All but the first of a bucket are removed.
2. the buckets' first rows are ranked within the key: at most ``spread`` rows of
   any key. The others ride along in their bucket, so no task takes a hot key.

``spread_for`` asks whether that is needed at all: where no key has many rows, one
window (a spread of 1) gives the same marks and moves every row once, not twice.

Inputs that are scans of parquet files need neither: there a row has an address (its
file and its number in it), and ``mark_first_at`` finds each key's first address by one
aggregate over the key, the order and a hash of the row, which is combined before it
is shuffled. One bitmap for every 32,768 rows of a file says which rows are first; the
second scan looks its rows up there. No other column is shuffled or sorted, and no row is,
but those that tie with the first of their key and differ from it (see ``first_addresses``).

Keys may have any comparable type; rows with a null key form one group.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, FractionalType, IntegralType, MapType

from ..session import work_path

FIRST = "_first"
MOST_ROWS_OF_KEY = 250_000  # that are ranked in one task
_BITMAP_BYTES = 4096 + 64  # of 32,768 rows, with its key
_TIE_BITS = 1 << 27  # that the hashes of tied keys are dealt to


class Deduped(NamedTuple):
    kept: DataFrame
    removed: DataFrame


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _comparable(df: DataFrame) -> list[tuple[str, Column]]:
    """(name, value) of every column; a map as its sorted entries."""
    return [(f.name, F.array_sort(F.map_entries(_q(f.name))) if isinstance(f.dataType, MapType) else _q(f.name))
            for f in df.schema.fields]


def total_order(df: DataFrame, key: str, order: Sequence[Column]) -> list[Column]:
    """``order`` followed by every other column ascending.

    With this tie-break only identical rows tie, so the winner's values are
    deterministic whatever the physical row order.
    """
    return [*order, *[value.asc_nulls_first() for name, value in _comparable(df) if name != key]]


def winners(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order`` (plus the all-column tie-break)."""
    # the key itself and nothing beside it: a hash before it would be shuffled with every row, and does not compress
    w = Window.partitionBy(_q(key)).orderBy(*total_order(df, key, order))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def mark_first(df: DataFrame, key: str, order: Sequence[Column], spread: int | None = None,
               apart: Column | None = None) -> DataFrame:
    """``df`` plus ``_first``: true for exactly one row per key, its first under ``order``.

    ``spread`` is the number of buckets that a key's rows are ranked in first
    (default: the session's shuffle partitions, so a hot key fills all tasks
    alike; 1: they are ranked once, by one window). Rows that meet ``apart`` are in
    no group: they are never first, and are spread over the tasks like a hot key.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = spread or partitions
    by = total_order(df, key, order)
    apart = F.lit(False) if apart is None else F.coalesce(apart, F.lit(False))
    row = F.xxhash64(F.spark_partition_id(), *[value for _, value in _comparable(df)])
    if buckets == 1:
        # rows apart have a slot and others have none, so that no row needs a copy of its key or a hash of it in the shuffle
        x = df.withColumn("_slot", F.when(apart, F.pmod(row, F.lit(partitions))).cast("int"))
        x = x.withColumn("_rank", F.row_number().over(Window.partitionBy(_q(key), "_slot").orderBy(*by)))
        return x.withColumn(FIRST, (F.col("_rank") == 1) & F.col("_slot").isNull()).drop("_slot", "_rank")
    x = df.withColumns({"_apart": apart, "_bucket": F.pmod(row, F.lit(buckets)).cast("int")})
    group = [_q(key), "_apart"]  # rows apart may have keys, but share no group with the others
    x = x.withColumn("_rn", F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*by)))
    final = (F.col("_rn") == 1) & ~F.col("_apart")
    x = x.withColumn("_slot", F.when(final, F.lit(-1)).otherwise(F.col("_bucket")))
    x = x.withColumn("_rank", F.row_number().over(Window.partitionBy(*group, "_slot").orderBy(*by)))
    return x.withColumn(FIRST, (F.col("_slot") == -1) & (F.col("_rank") == 1)).drop(
        "_apart", "_bucket", "_rn", "_slot", "_rank")


def spread_for(df: DataFrame, key: str, apart: Column | None = None, most: int = MOST_ROWS_OF_KEY) -> int | None:
    """1 if no key of ``df`` has more than ``most`` rows (one window will do), else None (``mark_first``'s default).

    Rows are counted by 65,536 hashes of the key, combined before the shuffle. A hash has at least as many
    rows as any of its keys, so 1 is never wrong; on very large inputs the answer may be None without a hot key.
    """
    keyed = df if apart is None else df.filter(~F.coalesce(apart, F.lit(False)))
    n = keyed.groupBy(F.pmod(F.xxhash64(_q(key)), F.lit(1 << 16)).alias("_h")).agg(F.count(F.lit(1)).alias("n"))
    return 1 if (n.agg(F.max("n")).first()[0] or 0) <= most else None


def removed_rows(df: DataFrame, key: str, order: Sequence[Column], spread: int | None = None) -> DataFrame:
    """Every row of ``df`` except the first per key."""
    return mark_first(df, key, order, spread).filter(~F.col(FIRST)).drop(FIRST)


def keep_latest(df: DataFrame, key: str, order: Sequence[Column], spread: int | None = None) -> Deduped:
    """Split ``df`` into the first row per key and the rows removed.

    ``order`` is the preference, e.g. ``[F.col('from_date').desc_nulls_last()]``.
    Rows with a null key form one group, as in a window partition.
    """
    return Deduped(winners(df, key, order), removed_rows(df, key, order, spread))


class By(NamedTuple):
    """A sort key: ascending with nulls first, or descending with nulls last."""

    value: Column
    desc: bool = False

    @property
    def order(self) -> Column:
        return self.value.desc_nulls_last() if self.desc else self.value.asc_nulls_first()


def _ascending(df: DataFrame, by: Sequence[By]) -> Column:
    """A struct whose natural order is that of ``by``."""
    kinds = df.select(*[b.value.alias(f"c{i}") for i, b in enumerate(by)]).schema.fields
    fields = []
    for b, kind in zip(by, kinds):
        if not b.desc:
            fields.append(b.value)
            continue
        fields.append(b.value.isNull())
        if isinstance(kind.dataType, IntegralType):
            fields.append(F.bitwise_not(b.value))  # -x - 1, which the least integer has as well
        elif isinstance(kind.dataType, FractionalType):
            fields += [~F.isnan(b.value.cast("double")), -b.value]  # NaN is the greatest
        elif isinstance(kind.dataType, DateType):
            fields.append(-F.unix_date(b.value))
        else:  # texts, and times as text: the digits of the bytes turned round; a longer text comes before its beginning
            turned = F.translate(F.hex(F.encode(b.value.cast("string"), "UTF-8")), "0123456789ABCDEF", "FEDCBA9876543210")
            fields.append(F.concat(turned, F.lit("~")))
    return F.struct(*[f.alias(f"o{i}") for i, f in enumerate(fields)])


def _addressed(scan: DataFrame) -> DataFrame:
    """``scan`` with the address of each row: ``_file`` (a hash of its path) and ``_row``, from 1."""
    return scan.select("*", F.xxhash64("_metadata.file_path").alias("_file"), (F.col("_metadata.row_index") + 1).alias("_row"))


def _bit(number: str) -> Column:
    """Whether the bitmap ``_bits`` that ``number`` falls into has its bit."""
    at = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (at % 8).cast("int")) == 1


def first_addresses(scan: DataFrame, key: str, by: Sequence[By], apart: Column | None = None) -> DataFrame:
    """(``_file``, ``_row``) of the first row of each key; as in ``mark_first`` all other columns break ties.

    A task sends one row for each of its keys: the least order, the least and the greatest hash of the rows that
    have it, and an address. Where the two hashes differ, the rows are compared by their columns. A bitmap of the
    hashes of such keys and orders (16 MB at most) leaves out the others before anything of them is shuffled, and a
    task sends the least of its rows only, however many tie. Without such keys the scan is not read for this at all.
    """
    spark = scan.sparkSession
    rest = [(name, value) for name, value in _comparable(scan) if name != key]
    x = _addressed(scan)
    if apart is not None:
        x = x.filter(~F.coalesce(apart, F.lit(False)))
    x = x.withColumns({"_k": _q(key), "_o": _ascending(scan, by)})
    best = x.select("_k", "_o", F.xxhash64(*[value for _, value in rest]).alias("_h"), "_file", "_row").groupBy("_k").agg(
        F.min(F.struct("_o", "_h", "_file", "_row")).alias("lo"), F.min(F.struct("_o", F.bitwise_not("_h").alias("_h"))).alias("hi"))
    tie = F.col("lo._h") != F.bitwise_not("hi._h")
    best = best.select("lo._file", "lo._row", F.when(tie, F.struct(F.col("_k").alias("_tk"), F.col("lo._o").alias("_to"))).alias("_tie"))
    path = work_path(spark, "first-rows")
    best.write.parquet(path)
    best = spark.read.schema(best.schema).parquet(path)
    first = best.filter("_tie is null").select("_file", "_row")
    ties = best.filter("_tie is not null").select("_tie.*")
    if ties.isEmpty():
        return first
    number = lambda k, o: F.pmod(F.xxhash64(k, o), F.lit(_TIE_BITS)) + 1
    wanted = ties.select(number("_tk", "_to").alias("_tie_bit")).groupBy(F.bitmap_bucket_number("_tie_bit").alias("_tie_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_tie_bit")).alias("_bits"))
    near = x.withColumn("_tie_bit", number("_k", "_o")).join(F.broadcast(wanted), F.bitmap_bucket_number("_tie_bit") == F.col("_tie_bucket"))
    order = F.struct(*[value.alias(f"c{i}") for i, (_, value) in enumerate(rest)], "_file", "_row")
    near = near.filter(_bit("_tie_bit")).groupBy("_k", "_o").agg(F.min(order).alias("m"))
    tied = near.join(ties, F.col("_k").eqNullSafe(F.col("_tk")) & F.col("_o").eqNullSafe(F.col("_to")))
    return first.unionByName(tied.select("m._file", "m._row"))


def mark_first_at(scan: DataFrame, key: str, by: Sequence[By], apart: Column | None = None, broadcast_bytes: int = 64 << 20) -> DataFrame:
    """``mark_first`` for a scan of parquet files (with at most projections and filters above it).

    The bitmaps take one bit a row. They are broadcast for as many files at a time
    as fit in ``broadcast_bytes``; each group of files is a scan of its own, pruned by path.
    """
    spark = scan.sparkSession
    first = first_addresses(scan, key, by, apart)
    bitmaps = first.groupBy("_file", F.bitmap_bucket_number("_row").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_row")).alias("_bits"))
    path = work_path(spark, "first-bitmaps")
    bitmaps.write.parquet(path)
    bitmaps = spark.read.schema(bitmaps.schema).parquet(path).withColumnsRenamed({"_file": "_bf", "_bucket": "_bb"})
    groups = max(1, -(-bitmaps.count() * _BITMAP_BYTES // broadcast_bytes))
    rows = None
    for g in range(groups):
        of_group = lambda file: F.pmod(file, F.lit(groups)) == g  # noqa: B023, E731
        part = scan.filter(of_group(F.xxhash64("_metadata.file_path"))) if groups > 1 else scan
        known = bitmaps.filter(of_group(F.col("_bf"))) if groups > 1 else bitmaps
        x = _addressed(part).join(F.broadcast(known), (F.col("_file") == F.col("_bf")) & (F.bitmap_bucket_number("_row") == F.col("_bb")), "left")
        x = x.withColumn(FIRST, F.coalesce(_bit("_row"), F.lit(False))).drop("_file", "_row", "_bf", "_bb", "_bits")
        rows = x if rows is None else rows.unionByName(x)
    return rows
