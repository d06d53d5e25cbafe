"""DataFrame operators. Everything here is lazy; only plans/ and sources/ run actions."""

from . import clean, dedupe, dims, fact, keys, quality, resolve, stage
from .clean import (
    backfill_make_year,
    classify_fuel,
    date_parts,
    emission_standard,
    invalid_dates,
    misalignment,
    missing_key,
    model_tokens,
    parse_dates,
    repair_office,
    valid_dates,
    valid_key,
)
from .dedupe import keep_latest
from .dims import build_dimensions
from .fact import assemble_fact
from .keys import surrogate_keys
from .resolve import best_match, registration_map, resolve_vehicles, similar_pairs
from .stage import CleanOptions, clean_and_stage, star_columns

__all__ = [
    "clean", "dedupe", "dims", "fact", "keys", "quality", "resolve", "stage",
    "backfill_make_year", "classify_fuel", "date_parts", "emission_standard", "invalid_dates",
    "misalignment", "missing_key", "model_tokens", "parse_dates", "repair_office", "valid_dates",
    "valid_key", "keep_latest", "build_dimensions", "assemble_fact", "surrogate_keys",
    "best_match", "registration_map", "resolve_vehicles", "similar_pairs",
    "CleanOptions", "clean_and_stage", "star_columns",
]
