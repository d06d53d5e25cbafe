"""Hashed surrogate keys (PRJ17) and typed fact date ids (PRJ22)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import rules as R


def surrogate_keys(
    df: DataFrame,
    model: str = "model_name",
    variant: str = "variant",
    make_year: str = "make_year",
    maker: str = "maker_name",
    office: str = "office_cd",
) -> DataFrame:
    """Add VEHICLE_ID, MANUFACTURER_ID, RTA_ID (lower-case hex SHA-256).

    The vehicle key joins ``lower(trim(model))|lower(trim(variant))|year`` with
    nulls skipped; manufacturer and office keys hash ``lower(trim(x))``, so a
    null maker or office gets a null id.
    """
    year_key = F.coalesce(F.col(make_year), F.lit(R.UNKNOWN))
    return df.withColumns(
        {
            "MAKE_YEAR_KEY": year_key,
            "VEHICLE_ID": X.sha256_key(X.vehicle_key_source(model, variant, year_key)),
            "MANUFACTURER_ID": X.sha256_key(X.norm(maker)),
            "RTA_ID": X.sha256_key(X.norm(office)),
        }
    )


def date_ids(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``{out: date_col}`` -> int yyyyMMdd columns; null stays null."""
    return df.withColumns({out: X.date_id(src) for out, src in columns.items()})
