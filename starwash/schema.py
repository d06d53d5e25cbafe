"""Canonical raw schema of a registrations file, and the conform step.

Every raw column is read as a string (the reference was written for ANSI-off
Spark; with ANSI on, comparing an inferred int column with '' raises).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Canonical names used by every operator, in file order.
RAW_COLUMNS = (
    "reg_no",
    "slno",
    "model_desc",
    "fuel",
    "colour",
    "vehicle_class",
    "make_year",
    "seat_capacity",
    "second_vehicle",
    "category",
    "maker_name",
    "office_cd",
    "from_date",
    "to_date_raw",
)

# Header names of the reference's raw registrations files, same order.
SOURCE_HEADER_NAMES = (
    "tempRegistrationNumber",
    "slno",
    "modelDesc",
    "fuel",
    "colour",
    "vehicleClass",
    "makeYear",
    "seatCapacity",
    "secondVehicle",
    "category",
    "makerName",
    "OfficeCd",
    "fromdate",
    "todate",
)

SOURCE_TO_CANONICAL = dict(zip(SOURCE_HEADER_NAMES, RAW_COLUMNS))

#: the text of a row that could not be parsed, null for all others
BAD_ROW = "_bad_row"

RAW_SCHEMA = StructType([StructField(n, StringType(), True) for n in SOURCE_HEADER_NAMES])
CANONICAL_RAW_SCHEMA = StructType([StructField(n, StringType(), True) for n in RAW_COLUMNS])


def conform(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename source columns to canonical names and cast the raw ones to string.

    Columns that are neither mapped nor canonical (e.g. tie-break or lineage
    columns) pass through unchanged. Canonical columns absent from the input
    are added as typed nulls, so every operator sees the full raw schema.
    """
    mapping = SOURCE_TO_CANONICAL if mapping is None else mapping
    present = set(df.columns)
    out = []
    for name in df.columns:
        target = mapping.get(name, name)
        expr = F.col(f"`{name}`")
        if target in RAW_COLUMNS:
            expr = expr.cast("string")
        out.append(expr.alias(target))
    renamed = {mapping.get(n, n) for n in present}
    for name in RAW_COLUMNS:
        if name not in renamed:
            out.append(F.lit(None).cast("string").alias(name))
    return df.select(*out)
