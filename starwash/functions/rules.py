"""Rule lists for the registrations cleaning.

FIXED VALUES: every pattern, label and format below must equal the reference's
for identical results. They are stated plainly, in the order the reference
applies them. Corrected variants (marked ``_FIXED`` / ``_CI``) are options that
deliberately differ and are never the default.
"""

from __future__ import annotations

# ---- fixed values (parity) -------------------------------------------------

UNKNOWN = "UNKNOWN"

# Office text that sometimes lands in the issue-date column, and state codes
# that are not offices.
OFFICE_TEXT_PATTERN = r"(?i)^(RTA|UNIT OFFICE|MVI|DTO|ZONAL|TRANSPORT).*"
STATE_CODE_PATTERN = r"(?i)^(TS|TG)$"

# Model description scrub: characters outside this class become one space.
MODEL_SCRUB_PATTERN = r"[^A-Za-z0-9\s\+\-\(\)\./]"
TRAILER_PATTERN = r"trailer|trailor|tipper|tractor|tanker"
ELECTRIC_PATTERN = r"\b(ev|bov|electric|hybrid)\b"
TRAILER_VARIANT = "TRAILER/TIPPER/TRACTOR/TANKER"
TOKEN_SPLIT_PATTERN = r"\s+"

# Fuel classifier: first matching rule wins, case-sensitive.
FUEL_RULES = (
    ("BATTERY|ELECTRIC", "ELECTRIC"),
    ("PETROL|GASOLINE", "PETROL"),
    ("DIESEL", "DIESEL"),
    ("CNG", "CNG"),
    ("LPG", "LPG"),
)

# Make year found in free text (no word boundary, so 19205 gives 1920).
MAKE_YEAR_PATTERN = r"(19\d{2}|20[0-2]\d)"

# Emission standard found in free text; alternatives are tried left to right,
# so BSVI extracts as BSV.
EMISSION_PATTERN = r"(BS\s?III[AB]?|BS\s?IV|BS\s?V|BS\s?VI)"
EMISSION_LABEL_ELECTRIC = "ELECTRIC"

# Mixed-format dates: keep these characters, map these separators to '/',
# then parse with the first shape whose digits match exactly.
DATE_DROP_PATTERN = r"[^\d/.\-]"
DATE_SEPARATOR_PATTERN = r"[\.-]"
DATE_SHAPES = (
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
    (r"^\d{2}/\d{2}/\d{2}$", "dd/MM/yy"),
    (r"^\d{4}/\d{2}/\d{2}$", "yyyy/MM/dd"),
)

# Misalignment classes (checked in this order).
MISALIGN_EXPIRY_SHAPE = r"^\d{2}/\d{2}/(\d{2}|\d{4})$"
MISALIGN_TEXT_PATTERN = r"(?i)null|dealer|agency"
MISALIGN_TYPE1 = "Type 1"
MISALIGN_TYPE2 = "Type 2"
MISALIGN_TYPE3 = "Type 3"
MISALIGN_CLEAN = "Clean"

# Emission values the quality check accepts.
EMISSION_DOMAIN = ("BSIII", "BSIV", "BSVI", "ELECTRIC", "UNKNOWN")

# Surrogate keys and the fact date id.
VEHICLE_KEY_SEPARATOR = "|"
FUZZY_KEY_SEPARATOR = " "
BLOCK_KEY_LENGTH = 2
DATE_ID_FORMAT = "yyyyMMdd"
DEFAULT_FUZZY_THRESHOLD = 3

# File sizing defaults.
DEFAULT_TARGET_MB = 128.0

# ---- corrected variants (options, never defaults) --------------------------

# Longest alternative first, so BSVI stays BSVI.
EMISSION_PATTERN_FIXED = r"(BS\s?III[AB]?|BS\s?VI|BS\s?IV|BS\s?V)"


def case_insensitive(rules):
    """The fuel rules with ``(?i)`` prefixed to every pattern."""
    return tuple(("(?i)" + pattern, label) for pattern, label in rules)


FUEL_RULES_CI = case_insensitive(FUEL_RULES)
