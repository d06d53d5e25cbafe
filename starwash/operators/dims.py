"""Deterministic star-schema dimensions (OP2, PRJ18-20, AGG3-4).

One row per surrogate id. Where the reference kept an arbitrary row per id, the
representative here is the least attribute row (nulls first, columns in order).
Staged rows are first reduced to distinct (id, attributes) by a hash aggregate
that is combined map-side; the pick then sorts only the few rows that are left.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import rules as R


class Dims(NamedTuple):
    vehicle: DataFrame
    manufacturer: DataFrame
    office: DataFrame


def representative(df: DataFrame, key: str, attrs: dict[str, Column]) -> DataFrame:
    """``key`` plus the least row of ``attrs`` per key."""
    distinct = df.select(key, *[expr.alias(name) for name, expr in attrs.items()]).distinct()
    return distinct.groupBy(key).agg(F.min(F.struct(*attrs)).alias("_r")).select(key, "_r.*")


def vehicle_attributes() -> dict[str, Column]:
    return {
        "MODEL_NAME": F.col("model_name"),
        "VARIANT": F.col("variant"),
        "EMISSION_STANDARD": F.col("emission_standard"),
        "FUEL": F.col("fuel_clean"),
        "COLOUR": F.coalesce(F.col("colour"), F.lit(R.UNKNOWN)),
        "VEHICLE_CLASS": F.coalesce(F.col("vehicle_class"), F.lit(R.UNKNOWN)),
        "MAKE_YEAR": F.col("make_year"),
        "SEAT_CAPACITY": X.legacy_int("seat_capacity"),
        "IS_ELECTRIC": F.col("is_electric"),
    }


def dim_vehicle(staged: DataFrame) -> DataFrame:
    return representative(staged, "VEHICLE_ID", vehicle_attributes())


def dim_manufacturer(staged: DataFrame) -> DataFrame:
    return representative(staged, "MANUFACTURER_ID", {"MAKER_NAME": F.col("maker_name")})


def dim_office(staged: DataFrame) -> DataFrame:
    office = representative(staged, "RTA_ID", {"RTA_OFFICE_CODE": F.col("office_cd")})
    return office.withColumns(
        {name: F.lit(None).cast("string") for name in ("RTA_REGION", "RTA_STATE", "RTA_CITY")}
    )


def build_dimensions(staged: DataFrame) -> Dims:
    return Dims(dim_vehicle(staged), dim_manufacturer(staged), dim_office(staged))
