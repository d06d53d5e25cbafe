"""The ``dirty`` view: raw registrations derived from the driver's lineitem and
part tables by arithmetic on their keys (text fixed by FIXTURES.md section 3; the
same SQL runs in Spark and DuckDB). ``pk, sk, qty`` are kept for tie-breaks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DIRTY_SQL = """
with b as (
  select l_orderkey k, l_linenumber n, l_suppkey sk, l_partkey pk, l_quantity qty,
         cast(cast(l_shipdate as date) as string) d, p_name, p_type, p_brand, p_size
  from lineitem join part on l_partkey = p_partkey)
select
  case when k % 97 = 0 then null when k % 97 = 1 then '   '
       else concat('T', cast(k as string)) end as reg_no,
  cast(n as string) as slno,
  case when pk % 31 = 0 then null
       when pk % 11 = 0 then concat(p_name, ' TRAILER#', p_type)
       when pk % 11 = 1 then concat(p_name, '@EV ', p_type)
       when pk % 11 = 2 then concat(p_name, ' ', p_type, ' BSVI')
       when pk % 11 = 3 then concat(p_name, ' ', p_type, ' BS IV 2018')
       when pk % 11 = 4 then concat(p_name, ' BSIIIA 19205')
       when pk % 11 = 5 then 'unk now'
       else concat(p_name, ' ', p_type) end as model_desc,
  case when sk % 8 = 0 then 'BATTERY' when sk % 8 = 1 then 'battery'
       when sk % 8 = 2 then 'PETROL/CNG' when sk % 8 = 3 then 'DIESEL'
       when sk % 8 = 4 then 'LPG' when sk % 8 = 5 then 'CNG'
       when sk % 8 = 6 then null else 'Diesel' end as fuel,
  case when pk % 9 = 0 then null else p_brand end as colour,
  case when pk % 10 = 0 then null else p_type end as vehicle_class,
  case when pk % 5 = 0 then null when pk % 5 = 1 then '' when pk % 5 = 2 then 'UNKNOWN'
       else cast(1990 + p_size % 30 as string) end as make_year,
  case when p_size % 13 = 0 then 'n/a' else cast(p_size as string) end as seat_capacity,
  case when sk % 17 = 0 then null else concat(' ', p_brand, ' ') end as maker_name,
  case when sk % 7 = 0 then null when sk % 7 = 1 then 'ts'
       else concat('OFF', cast(sk % 40 as string)) end as office_cd,
  case when (k + n) % 23 = 0 then 'RTA MEDAK'
       when (k + n) % 23 = 1 then '31/02/2023'
       when (k + n) % 23 = 2 then null
       when (k + n) % 23 = 3 then concat(d, ' 00:00:00')
       when (k + n) % 4 = 0 then concat(substr(d,9,2), '/', substr(d,6,2), '/', substr(d,1,4))
       when (k + n) % 4 = 1 then concat(substr(d,9,2), '.', substr(d,6,2), '.', substr(d,3,2))
       when (k + n) % 4 = 2 then d
       else concat(substr(d,9,2), '-', substr(d,6,2), '-', substr(d,1,4)) end as from_date,
  case when (k + n) % 19 = 0 then 'SRI AUTO AGENCY'
       when (k + n) % 3 = 0 then concat(substr(d,9,2), '/', substr(d,6,2), '/', substr(d,1,4))
       else d end as to_date_raw,
  pk, sk, qty
from b
"""

# Rows of the view that one task derives at most. Left alone, AQE sizes these tasks by narrow compressed rows, two to
# three million in each, and what sorts them afterwards holds them wide and in full.
ROWS_IN_TASK = 1_000_000

# Total order that makes the keep-latest dedupe deterministic on this view.
DIRTY_TIE_BREAK = ("slno", "pk", "sk", "qty")


def register_tables(spark: SparkSession, sf_dir: str, names=("lineitem", "part")) -> None:
    tasks = -(-table(spark, sf_dir, "lineitem").count() // ROWS_IN_TASK)  # from the files' footers
    for name in names:
        df = table(spark, sf_dir, name)
        if name == "lineitem":
            # the view takes the date only, and its number of days is less to shuffle than a time
            df = df.withColumn("l_shipdate", F.unix_date(df["l_shipdate"].cast("date")))
            if tasks > spark.sparkContext.defaultParallelism:  # with fewer, AQE fills the cores
                df = df.repartition(tasks, "l_partkey")
            # made a date again behind that shuffle: a join takes partitions fewer than the session's only if they are not its own
            df = df.withColumn("l_shipdate", F.date_from_unix_date("l_shipdate"))
        # parts are joined by a shuffle at any size: as compressed files they look small enough to be broadcast long
        # after they are not, and rows that are made wide in the scan of lineitem fill its few tasks
        (df.hint("shuffle_hash") if name == "part" else df).createOrReplaceTempView(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty registrations view over ``sf_dir`` (all of lineitem)."""
    register_tables(spark, sf_dir)
    return spark.sql(DIRTY_SQL)


# Columns of the dirty view that carry the raw registration fields.
DIRTY_RAW = (
    "reg_no", "slno", "model_desc", "fuel", "colour", "vehicle_class", "make_year",
    "seat_capacity", "maker_name", "office_cd", "from_date", "to_date_raw", "pk", "sk", "qty",
)
