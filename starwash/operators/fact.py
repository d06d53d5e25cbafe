"""Fact table assembly (OP4, JN6-7, PRJ22-23, FLT9).

A vehicle that resolves to its own id needs no map row, and for the dimension
built in the same run nearly all do. So staged rows are joined only to the map
rows that change something: a fuzzy match, another id, or several matches. That
remainder is usually small enough for AQE to broadcast by its measured size, and
staged rows are not shuffled by vehicle; if it is not, the sort-merge join
splits skewed vehicles. The reference's manufacturer re-join on a unique key is
an identity and is written as a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as X
from .resolve import VEHICLE, vehicle_join_condition

FACT_COLUMNS = (
    "VEHICLE_ID",
    "MANUFACTURER_ID",
    "RTA_ID",
    "REGISTRATION_ISSUE_DATE_ID",
    "REGISTRATION_EXPIRY_DATE_ID",
    "REGISTRATION_YEAR",
    "TRANSPORT_TYPE",
    "TEMP_REGISTRATION_NUMBER",
    "SLNO",
    "IS_FUZZY_MATCH",
    "COLOUR",
    "FUEL_TYPE",
    "MODEL_NAME",
    "EMISSION_STANDARD",
)


def match_counts(staged: DataFrame, vehicle_map: DataFrame) -> DataFrame:
    """One row: exact_matches, fuzzy_matches and total_resolved fact rows.

    Registrations are counted per vehicle (map-side combined), then joined to the map.
    """
    n = staged.filter(F.col("from_date_parsed").isNotNull()).groupBy(*VEHICLE).agg(F.count(F.lit(1)).alias("n")).alias("s")
    met = n.join(vehicle_map.alias("vm"), vehicle_join_condition("s", "vm"))

    def total(cond):
        return F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")

    fuzzy = F.col("IS_FUZZY_MATCH")
    return met.agg(total(~fuzzy).alias("exact_matches"), total(fuzzy).alias("fuzzy_matches"),
                   total(F.lit(True)).alias("total_resolved"))


def assemble_fact(staged: DataFrame, vehicle_map: DataFrame, key: str = "reg_no") -> DataFrame:
    """One fact row per staged row and matching map row; unmatched rows keep their own id."""
    s = staged.alias("s")
    matches = F.count(F.lit(1)).over(Window.partitionBy(*VEHICLE))
    vm = vehicle_map.select(*VEHICLE, "VEHICLE_ID_resolved", "IS_FUZZY_MATCH", matches.alias("_matches")).filter(
        F.col("IS_FUZZY_MATCH") | (F.col("VEHICLE_ID_resolved") != F.col("VEHICLE_ID")) | (F.col("_matches") > 1)).alias("vm")
    joined = s.join(vm, vehicle_join_condition("s", "vm"), "left")
    cols = [
        F.coalesce(F.col("vm.VEHICLE_ID_resolved"), F.col("s.VEHICLE_ID")).alias("VEHICLE_ID"),
        F.col("s.MANUFACTURER_ID").alias("MANUFACTURER_ID"),
        F.col("s.RTA_ID").alias("RTA_ID"),
        X.date_id("s.from_date_parsed").alias("REGISTRATION_ISSUE_DATE_ID"),
        X.date_id("s.to_date_parsed").alias("REGISTRATION_EXPIRY_DATE_ID"),
        F.year(F.col("s.from_date_parsed")).alias("REGISTRATION_YEAR"),
        F.col("s.vehicle_class").alias("TRANSPORT_TYPE"),
        F.col(f"s.{key}").alias("TEMP_REGISTRATION_NUMBER"),
        F.col("s.slno").alias("SLNO"),
        F.coalesce(F.col("vm.IS_FUZZY_MATCH"), F.lit(False)).alias("IS_FUZZY_MATCH"),
        F.col("s.colour").alias("COLOUR"),
        F.col("s.fuel_clean").alias("FUEL_TYPE"),
        F.col("s.model_name").alias("MODEL_NAME"),
        F.col("s.emission_standard").alias("EMISSION_STANDARD"),
    ]
    return joined.select(*cols).filter(F.col("REGISTRATION_ISSUE_DATE_ID").isNotNull())
