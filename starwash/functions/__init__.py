"""Column expressions and the fixed rule lists."""

from . import rules
from .columns import (
    blank,
    date_id,
    first_match,
    fuzzy_key,
    legacy_int,
    norm,
    parse_mixed_date,
    scrub_text,
    sha256_key,
    unknown_if_blank,
    vehicle_key_source,
)

__all__ = [
    "rules",
    "blank",
    "date_id",
    "first_match",
    "fuzzy_key",
    "legacy_int",
    "norm",
    "parse_mixed_date",
    "scrub_text",
    "sha256_key",
    "unknown_if_blank",
    "vehicle_key_source",
]
