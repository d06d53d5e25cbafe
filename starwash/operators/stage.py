"""Clean and stage raw registrations (OP1), then derive star columns.

Step order is observable and kept: missing key -> dedupe on the raw issue-date
string -> office repair -> model tokens -> date parse -> invalid-date split ->
fuel, make year, date parts. Emission standard and surrogate keys follow.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as X
from ..functions import rules as R
from ..schema import BAD_ROW
from ..sources import sinks
from . import clean
from .dedupe import FIRST, By, Deduped, keep_latest, mark_first, mark_first_at, spread_for
from .keys import surrogate_keys

REJECT_REASON = "reject_reason"
MALFORMED = "malformed_row"
MISSING_KEY = "missing_key"
DUPLICATE = "duplicate"
INVALID_DATE = "invalid_date"
STAGED = "staged"
KEPT = "kept"  # of a row that has passed the dedupe and is not derived yet
KEPT_SPLIT = 16 << 20  # bytes of kept rows in a task that derives their columns: the chain is work for the CPU


@dataclass(frozen=True)
class CleanOptions:
    """Parameters of the cleaning; defaults reproduce the reference.

    ``dedupe_order``: ``"raw"`` sorts the raw issue-date string (reference
    behaviour); ``"latest_valid"`` sorts by the parsed date first.
    ``tie_break``: extra ascending columns after the issue date.
    ``spread``: buckets that a key's rows are ranked in first when duplicates
    are marked (default: the session's shuffle partitions; 1: one window, see
    ``spread_known``).
    ``row_addresses``: the input is a scan of parquet files (projections and filters
    above it), so first rows are marked by their addresses and no row is shuffled.
    """

    key: str = "reg_no"
    from_date: str = "from_date"
    to_date: str = "to_date_raw"
    dedupe_order: str = "raw"
    tie_break: tuple[str, ...] = ()
    fuel_rules: tuple = R.FUEL_RULES
    emission_pattern: str = R.EMISSION_PATTERN
    date_shapes: tuple = field(default=R.DATE_SHAPES)
    spread: int | None = None
    row_addresses: bool = False


class Staged(NamedTuple):
    staged: DataFrame
    missing: DataFrame
    duplicates: DataFrame
    invalid: DataFrame


def dedupe_by(opts: CleanOptions) -> list[By]:
    by = [By(F.col(opts.from_date), desc=True)]
    if opts.dedupe_order == "latest_valid":
        by.insert(0, By(X.parse_mixed_date(opts.from_date, opts.date_shapes), desc=True))
    elif opts.dedupe_order != "raw":
        raise ValueError(f"unknown dedupe_order {opts.dedupe_order!r}")
    return by + [By(F.col(t)) for t in opts.tie_break]


def mark_latest(df: DataFrame, opts: CleanOptions, apart=None) -> DataFrame:
    """``df`` with ``_first``, by row addresses or by windows."""
    if opts.row_addresses:
        return mark_first_at(df, opts.key, dedupe_by(opts), apart)
    return mark_first(df, opts.key, [b.order for b in dedupe_by(opts)], opts.spread, apart)


def no_key(df: DataFrame, opts: CleanOptions):
    """Malformed rows and rows without a key."""
    malformed = F.col(BAD_ROW).isNotNull() if BAD_ROW in df.columns else F.lit(False)
    return malformed | X.blank(opts.key)


def spread_known(df: DataFrame, opts: CleanOptions) -> CleanOptions:
    """``opts`` with a spread of 1 if the rows of ``df``, counted by key, allow it (one job over the key column)."""
    if opts.row_addresses or opts.spread:
        return opts
    return replace(opts, spread=spread_for(df, opts.key, no_key(df, opts)))


def dedupe(df: DataFrame, opts: CleanOptions = CleanOptions()):
    """Missing-key split plus keep-latest: ``(missing, kept, removed)``."""
    missing, keyed = clean.missing_key(df, opts.key), clean.valid_key(df, opts.key)
    if opts.row_addresses:
        marked = mark_latest(keyed, opts)
        kept, removed = Deduped(marked.filter(FIRST).drop(FIRST), marked.filter(~F.col(FIRST)).drop(FIRST))
    else:
        kept, removed = keep_latest(keyed, opts.key, [b.order for b in dedupe_by(opts)], opts.spread)
    return missing, kept, removed


def repair_and_parse(kept: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    x = clean.repair_office(kept, from_date=opts.from_date)
    x = clean.model_tokens(x)
    return clean.parse_dates(x, (opts.from_date, opts.to_date), shapes=opts.date_shapes)


def finish_stage(x: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    x = clean.classify_fuel(x, rules=opts.fuel_rules)
    x = clean.backfill_make_year(x)
    return clean.date_parts(x)


def clean_and_stage(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> Staged:
    """OP1 as four lazy frames; nothing runs until an action."""
    missing, kept, removed = dedupe(raw, opts)
    parsed = repair_and_parse(kept, opts)
    invalid = clean.invalid_dates(parsed)
    staged = finish_stage(clean.valid_dates(parsed), opts)
    return Staged(staged, missing, removed, invalid)


def star_columns(staged: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Emission standard and surrogate keys (PRJ16, PRJ17)."""
    return surrogate_keys(clean.emission_standard(staged, pattern=opts.emission_pattern))


def tagged_rows(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Every input row once, tagged with ``reject_reason``.

    Reasons: malformed_row (where the input has a column ``_bad_row`` with the text of
    a row that could not be parsed), missing_key, duplicate, invalid_date, staged. Kept rows
    (invalid_date, staged) carry the derived columns; staged rows also the star
    columns. By windows the input is read once; rows without a key ride through the
    same windows, spread over all tasks. By row addresses it is read twice, the
    first time the key and order columns only. Rejected rows are nulls to the repair and
    parse chain, so it costs them nothing, and they leave as they came.
    """
    columns = raw.columns
    keyless = no_key(raw, opts)
    rows = mark_latest(raw, opts, apart=keyless)
    kept = F.col(FIRST)
    rows = rows.select(
        FIRST, keyless.alias("_no_key"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_raw"),
        *[F.when(kept, F.col(f"`{c}`")).alias(c) for c in columns])
    x = repair_and_parse(rows, opts)
    x = finish_stage(x.withColumn("_make_year_raw", F.col("make_year")), opts)
    x = star_columns(x, opts)
    dated = F.col("from_date_parsed").isNotNull()
    derived = [c for c in x.columns if c not in (*columns, FIRST, "_no_key", "_raw", "_make_year_raw")]
    # invalid-date rows leave with their raw make year, as the reference's quarantine
    value = {c: F.col(f"`{c}`") for c in columns}
    value["make_year"] = F.when(dated, F.col("make_year")).otherwise(F.col("_make_year_raw"))
    unparsed = F.col("_raw").getField(BAD_ROW).isNotNull() if BAD_ROW in columns else F.lit(False)
    reason = (F.when(unparsed, MALFORMED).when(F.col("_no_key"), MISSING_KEY).when(~kept, DUPLICATE).when(dated, STAGED).otherwise(INVALID_DATE))
    return x.select(
        *[F.when(kept, value[c]).otherwise(F.col("_raw").getField(c)).alias(c) for c in columns],
        reason.alias(REJECT_REASON), *[F.when(kept, F.col(c)).alias(c) for c in derived])


def marked_rows(raw: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Every input row as it came, with ``reject_reason``: malformed_row, missing_key, duplicate or kept."""
    keyless = no_key(raw, opts)
    unparsed = F.col(BAD_ROW).isNotNull() if BAD_ROW in raw.columns else F.lit(False)
    reason = F.when(unparsed, MALFORMED).when(keyless, MISSING_KEY).when(~F.col(FIRST), DUPLICATE).otherwise(KEPT)
    return mark_latest(raw, opts, apart=keyless).withColumn(REJECT_REASON, reason).drop(FIRST)


def derived_rows(kept: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Kept rows (raw columns) with the derived columns and ``reject_reason``: staged or invalid_date, as ``tagged_rows`` has them."""
    columns = kept.columns
    x = repair_and_parse(kept, opts)
    x = star_columns(finish_stage(x.withColumn("_make_year_raw", F.col("make_year")), opts), opts)
    dated = F.col("from_date_parsed").isNotNull()
    # invalid-date rows leave with their raw make year, as the reference's quarantine
    value = {c: F.col(f"`{c}`") for c in columns}
    value["make_year"] = F.when(dated, F.col("make_year")).otherwise(F.col("_make_year_raw")).alias("make_year")
    return x.select(*value.values(), F.when(dated, STAGED).otherwise(INVALID_DATE).alias(REJECT_REASON),
                    *[c for c in x.columns if c not in (*columns, "_make_year_raw")])


def write_tagged(raw: DataFrame, path: str, opts: CleanOptions = CleanOptions(),
                 observe_marked=None, observe_derived=None) -> DataFrame:
    """The rows of ``tagged_rows``, written below ``path`` by reason and read back.

    All rows are written as they came, by what the dedupe says of them; only the kept ones are read again, and
    go through the repair and parse chain. So rejected rows pay for the window and one write. ``observe_*``:
    (Observation, [metric columns]) on either write.
    """
    watched = lambda df, what: df.observe(what[0], *what[1]) if what else df
    marked = sinks.write_then_read(watched(marked_rows(raw, opts), observe_marked), f"{path}/marked", partition_by=[REJECT_REASON])
    kept = marked.filter(F.col(REJECT_REASON) == KEPT).drop(REJECT_REASON)
    derived = derived_rows(kept, opts)
    with sinks.session_conf(raw.sparkSession, {"spark.sql.files.maxPartitionBytes": str(KEPT_SPLIT)}):
        derived = sinks.write_then_read(watched(derived, observe_derived), f"{path}/derived", partition_by=[REJECT_REASON])
    rejects = marked.filter(F.col(REJECT_REASON) != KEPT)
    return derived.unionByName(rejects, allowMissingColumns=True)


def quarantine(tagged: DataFrame, raw_columns: list[str]) -> DataFrame:
    """Rejected rows of a (written) ``tagged_rows`` table, raw columns plus reason
    (a pruned read where the table is partitioned by reason)."""
    return tagged.filter(F.col(REJECT_REASON) != STAGED).select(*[F.col(f"`{c}`") for c in raw_columns], REJECT_REASON)
