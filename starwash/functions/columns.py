"""Column expressions: pure ``Column -> Column`` builders over built-in functions.

Everything here stays inside whole-stage codegen; no UDFs. All functions are
safe under ANSI mode (``try_*`` forms where the reference relied on ANSI-off).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def blank(x) -> Column:
    """Null or only spaces (``trim`` strips spaces only)."""
    x = c(x)
    return x.isNull() | (F.trim(x) == "")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row, however often ``use`` has it.

    An expression that is used in several places is otherwise written out in each, and
    in the branches of a CASE Spark evaluates it each time."""
    return F.get(F.transform(F.array(value), use), 0)


def first_match(value: Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Ordered regex classifier: the label of the first matching rule."""
    out = None
    for pattern, label in rules:
        cond = value.rlike(pattern)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(default))


def parse_mixed_date(x, shapes=R.DATE_SHAPES) -> Column:
    """Keep digits and separators, unify separators to '/', parse by exact shape.

    Unknown shapes and invalid calendar dates give null (``try_to_date``).
    """
    cleaned = F.regexp_replace(
        F.trim(F.regexp_replace(c(x).cast("string"), R.DATE_DROP_PATTERN, "")),
        R.DATE_SEPARATOR_PATTERN,
        "/",
    )

    def by_shape(text):
        out = None
        for shape, fmt in shapes:
            parsed, cond = F.try_to_date(text, fmt), text.rlike(shape)
            out = F.when(cond, parsed) if out is None else out.when(cond, parsed)
        return out.otherwise(F.lit(None).cast("date"))

    return let(cleaned, by_shape)


def legacy_int(x) -> Column:
    """String to int as Spark casts with ANSI off, without turning ANSI off.

    Surrounding whitespace/control characters are ignored, a sign is allowed,
    a well-formed fraction is truncated ('4.7' -> 4, '.5' -> 0); anything
    else, and overflow, gives null. (``try_cast`` would give null for '4.7'.)
    """
    t = F.regexp_replace(c(x).cast("string"), r"^[\s\x00-\x1F\x7F]+|[\s\x00-\x1F\x7F]+$", "")
    well_formed = t.rlike(r"^[+-]?[0-9]*([.][0-9]*)?$") & ~t.isin("", "+", "-")
    whole = F.regexp_extract(t, r"^[+-]?[0-9]*", 0)
    whole = F.when(whole.isin("", "+", "-"), F.lit("0")).otherwise(whole)
    return F.when(well_formed, whole.try_cast("int"))


def date_id(x) -> Column:
    """Date as int yyyyMMdd; null stays null."""
    return F.date_format(c(x).cast("date"), R.DATE_ID_FORMAT).cast("int")


def scrub_text(x) -> Column:
    return F.trim(F.regexp_replace(c(x), R.MODEL_SCRUB_PATTERN, " "))


def sha256_key(*parts, sep: str = R.VEHICLE_KEY_SEPARATOR) -> Column:
    """Lower-case hex SHA-256 of the parts joined by ``sep`` (nulls skipped)."""
    src = parts[0] if len(parts) == 1 else F.concat_ws(sep, *parts)
    return F.sha2(src, 256)


def norm(x) -> Column:
    """The normal form of a natural-key part: ``lower(trim(x))``."""
    return F.lower(F.trim(c(x)))


def vehicle_key_source(model, variant, make_year_key) -> Column:
    return F.concat_ws(R.VEHICLE_KEY_SEPARATOR, norm(model), norm(variant), c(make_year_key))


def fuzzy_key(model, variant) -> Column:
    return norm(F.concat_ws(R.FUZZY_KEY_SEPARATOR, c(model), c(variant)))


def unknown_if_blank(x) -> Column:
    x = c(x)
    return F.when(x.isNull() | (x == ""), F.lit(R.UNKNOWN)).otherwise(x)
