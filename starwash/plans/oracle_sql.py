"""DuckDB statements that state each registered query's expected result.

They are written independently of the Spark operators, step by step as the
reference describes them (window ``row_number`` where it used one), over the
driver's tables (``lineitem``, ``part``, ``orders``, ``customer``, ...). The
``dirty`` view text is shared with Spark (it is the fixture, not the logic).
"""

from __future__ import annotations

from types import SimpleNamespace

from .fixtures import DIRTY_SQL

# FIXED VALUES, written out a second time on purpose: a slip in the library's own list then shows as a mismatch.
R = SimpleNamespace(
    UNKNOWN="UNKNOWN",
    OFFICE_TEXT_PATTERN=r"(?i)^(RTA|UNIT OFFICE|MVI|DTO|ZONAL|TRANSPORT).*",
    STATE_CODE_PATTERN=r"(?i)^(TS|TG)$",
    MODEL_SCRUB_PATTERN=r"[^A-Za-z0-9\s\+\-\(\)\./]",
    TRAILER_PATTERN=r"trailer|trailor|tipper|tractor|tanker",
    ELECTRIC_PATTERN=r"\b(ev|bov|electric|hybrid)\b",
    TRAILER_VARIANT="TRAILER/TIPPER/TRACTOR/TANKER",
    TOKEN_SPLIT_PATTERN=r"\s+",
    FUEL_RULES=(("BATTERY|ELECTRIC", "ELECTRIC"), ("PETROL|GASOLINE", "PETROL"), ("DIESEL", "DIESEL"), ("CNG", "CNG"), ("LPG", "LPG")),
    FUEL_RULES_CI=(("(?i)BATTERY|ELECTRIC", "ELECTRIC"), ("(?i)PETROL|GASOLINE", "PETROL"), ("(?i)DIESEL", "DIESEL"),
                   ("(?i)CNG", "CNG"), ("(?i)LPG", "LPG")),
    MAKE_YEAR_PATTERN=r"(19\d{2}|20[0-2]\d)",
    EMISSION_PATTERN=r"(BS\s?III[AB]?|BS\s?IV|BS\s?V|BS\s?VI)",
    EMISSION_PATTERN_FIXED=r"(BS\s?III[AB]?|BS\s?VI|BS\s?IV|BS\s?V)",
    DATE_DROP_PATTERN=r"[^\d/.\-]",
    DATE_SEPARATOR_PATTERN=r"[\.-]",
    MISALIGN_EXPIRY_SHAPE=r"^\d{2}/\d{2}/(\d{2}|\d{4})$",
    MISALIGN_TEXT_PATTERN=r"(?i)null|dealer|agency",
    DEFAULT_FUZZY_THRESHOLD=3,
)

ORDER_KEEP = ("from_date DESC NULLS LAST, slno ASC NULLS FIRST, pk ASC NULLS FIRST, "
              "sk ASC NULLS FIRST, qty ASC NULLS FIRST")
RAW = "reg_no, slno, model_desc, fuel, colour, vehicle_class, make_year, seat_capacity, maker_name, office_cd, from_date, to_date_raw, pk, sk, qty"
IDS = "reg_no, slno, pk, sk, qty"


def _fuel_case(col: str, rules) -> str:
    whens = " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{label}'" for p, label in rules)
    return f"upper(CASE {whens} ELSE '{R.UNKNOWN}' END)"


def _date_clean(col: str) -> str:
    return (f"regexp_replace(trim(regexp_replace({col}, '{R.DATE_DROP_PATTERN}', '', 'g')), "
            f"'{R.DATE_SEPARATOR_PATTERN}', '/', 'g')")


def _date_case(c: str) -> str:
    return (
        f"CASE WHEN regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{4}}$') THEN CAST(try_strptime({c}, '%d/%m/%Y') AS DATE) "
        f"WHEN regexp_matches({c}, '^\\d{{2}}/\\d{{2}}/\\d{{2}}$') "
        f"THEN CAST(try_strptime(substr({c}, 1, 6) || '20' || substr({c}, 7, 2), '%d/%m/%Y') AS DATE) "
        f"WHEN regexp_matches({c}, '^\\d{{4}}/\\d{{2}}/\\d{{2}}$') THEN CAST(try_strptime({c}, '%Y/%m/%d') AS DATE) "
        "ELSE NULL END"
    )


def repair_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """Office repair steps over ``src``; the last CTE is ``{p}rep3``."""
    return [
        (f"{p}rep1", f"""SELECT * REPLACE (
            CASE WHEN regexp_matches(from_date, '{R.OFFICE_TEXT_PATTERN}') AND office_cd IS NULL THEN from_date ELSE office_cd END AS office_cd,
            CASE WHEN regexp_matches(from_date, '{R.OFFICE_TEXT_PATTERN}') THEN NULL ELSE from_date END AS from_date)
          FROM {src}"""),
        (f"{p}rep2", f"""SELECT * REPLACE (CASE WHEN regexp_matches(office_cd, '{R.STATE_CODE_PATTERN}') THEN NULL ELSE office_cd END AS office_cd)
          FROM {p}rep1"""),
        (f"{p}rep3", f"""SELECT * REPLACE (CASE WHEN office_cd IS NULL AND from_date IS NOT NULL THEN from_date ELSE office_cd END AS office_cd)
          FROM {p}rep2"""),
    ]


def token_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """Model tokens over ``src``; the last CTE is ``{p}tok4``."""
    return [
        (f"{p}tok1", f"SELECT *, trim(regexp_replace(model_desc, '{R.MODEL_SCRUB_PATTERN}', ' ', 'g')) AS model_clean FROM {src}"),
        (f"{p}tok2", f"""SELECT *, regexp_matches(lower(model_clean), '{R.TRAILER_PATTERN}') AS is_trailer,
            regexp_matches(lower(model_clean), '{R.ELECTRIC_PATTERN}') AS is_electric,
            string_split_regex(model_clean, '{R.TOKEN_SPLIT_PATTERN}') AS _words FROM {p}tok1"""),
        (f"{p}tok3", f"""SELECT * EXCLUDE (_words),
            upper(CASE WHEN is_trailer THEN model_clean ELSE _words[1] END) AS model_name,
            upper(CASE WHEN is_trailer THEN '{R.TRAILER_VARIANT}'
                       ELSE trim(array_to_string(_words[2:], ' ')) END) AS _variant
          FROM {p}tok2"""),
        (f"{p}tok4", f"""SELECT * EXCLUDE (_variant),
            CASE WHEN _variant IS NULL OR _variant = '' THEN '{R.UNKNOWN}' ELSE _variant END AS variant FROM {p}tok3"""),
    ]


def parse_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """Date parsing over ``src``; the last CTE is ``{p}parsed``."""
    return [
        (f"{p}par1", f"SELECT *, {_date_clean('from_date')} AS _fc, {_date_clean('to_date_raw')} AS _tc FROM {src}"),
        (f"{p}parsed", f"SELECT * EXCLUDE (_fc, _tc), {_date_case('_fc')} AS from_date_parsed, "
                       f"{_date_case('_tc')} AS to_date_parsed FROM {p}par1"),
    ]


def backfill_sql(src: str) -> str:
    return f"""SELECT * EXCLUDE (_found) REPLACE (
        CASE WHEN make_year IS NULL OR make_year = '' OR make_year = '{R.UNKNOWN}'
             THEN CASE WHEN _found <> '' THEN _found ELSE '{R.UNKNOWN}' END
             ELSE make_year END AS make_year)
      FROM (SELECT *, regexp_extract(model_clean, '{R.MAKE_YEAR_PATTERN}', 0) AS _found FROM {src})"""


def emission_sql(src: str, pattern: str = R.EMISSION_PATTERN) -> str:
    return f"""SELECT * EXCLUDE (_e), CASE WHEN _e IS NULL OR _e = '' THEN '{R.UNKNOWN}' ELSE _e END AS emission_standard
      FROM (SELECT *, CASE WHEN is_electric THEN 'ELECTRIC' ELSE regexp_extract(model_clean, '{pattern}', 0) END AS _e
            FROM {src})"""


def _least_per(key: str, attrs: list[tuple[str, str]]) -> str:
    """The least attribute row per key."""
    names = ", ".join(name for name, _ in attrs)
    order = ", ".join(f"{name} ASC NULLS FIRST" for name, _ in attrs)
    cols = ", ".join(f"{expr} AS {name}" for name, expr in attrs)
    return (f"SELECT {key}, {names} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn "
            f"FROM (SELECT {key}, {cols} FROM staged)) WHERE _rn = 1")


CHAIN: list[tuple[str, str]] = [
    ("dirty", DIRTY_SQL),
    ("valid", "SELECT * FROM dirty WHERE NOT (reg_no IS NULL OR trim(reg_no) = '')"),
    ("ranked", f"SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY {ORDER_KEEP}) AS _rn FROM valid"),
    ("kept", "SELECT * EXCLUDE (_rn) FROM ranked WHERE _rn = 1"),
    ("removed", "SELECT * EXCLUDE (_rn) FROM ranked WHERE _rn > 1"),
    *repair_ctes("kept", "k"),
    *token_ctes("krep3", "k"),
    *parse_ctes("ktok4", "k"),
    ("invalid", "SELECT * FROM kparsed WHERE from_date_parsed IS NULL"),
    ("st1", f"SELECT *, {_fuel_case('fuel', R.FUEL_RULES)} AS fuel_clean FROM kparsed WHERE from_date_parsed IS NOT NULL"),
    ("st2", backfill_sql("st1")),
    ("st3", "SELECT *, CAST(year(from_date_parsed) AS INTEGER) AS year, CAST(month(from_date_parsed) AS INTEGER) AS month FROM st2"),
    ("st4", emission_sql("st3")),
    ("staged", f"""SELECT *, coalesce(make_year, '{R.UNKNOWN}') AS MAKE_YEAR_KEY,
        sha256(concat_ws('|', lower(trim(model_name)), lower(trim(variant)), coalesce(make_year, '{R.UNKNOWN}'))) AS VEHICLE_ID,
        sha256(lower(trim(maker_name))) AS MANUFACTURER_ID,
        sha256(lower(trim(office_cd))) AS RTA_ID
      FROM st4"""),
    ("dim_vehicle", _least_per("VEHICLE_ID", [
        ("MODEL_NAME", "model_name"), ("VARIANT", "variant"), ("EMISSION_STANDARD", "emission_standard"), ("FUEL", "fuel_clean"),
        ("COLOUR", f"coalesce(colour, '{R.UNKNOWN}')"), ("VEHICLE_CLASS", f"coalesce(vehicle_class, '{R.UNKNOWN}')"),
        ("MAKE_YEAR", "make_year"), ("SEAT_CAPACITY", "TRY_CAST(seat_capacity AS INTEGER)"), ("IS_ELECTRIC", "is_electric")])),
    ("dim_manufacturer", _least_per("MANUFACTURER_ID", [("MAKER_NAME", "maker_name")])),
    ("dim_office", _least_per("RTA_ID", [("RTA_OFFICE_CODE", "office_cd"), ("RTA_REGION", "CAST(NULL AS VARCHAR)"),
                                         ("RTA_STATE", "CAST(NULL AS VARCHAR)"), ("RTA_CITY", "CAST(NULL AS VARCHAR)")])),
    ("sm", "SELECT reg_no, VEHICLE_ID, model_name, variant, MAKE_YEAR_KEY FROM staged"),
    ("dv", """SELECT VEHICLE_ID AS dv_id, lower(trim(MODEL_NAME)) AS dv_model, lower(trim(VARIANT)) AS dv_variant,
        MAKE_YEAR AS dv_make_year FROM dim_vehicle"""),
    ("exact", """SELECT s.reg_no, d.dv_id AS VEHICLE_ID_resolved FROM sm s JOIN dv d
        ON lower(trim(s.model_name)) = d.dv_model AND lower(trim(s.variant)) = d.dv_variant AND s.MAKE_YEAR_KEY = d.dv_make_year"""),
    ("unresolved", "SELECT * FROM sm s WHERE NOT EXISTS (SELECT 1 FROM exact e WHERE e.reg_no = s.reg_no)"),
    ("cand", """SELECT u.reg_no, d.dv_id,
        levenshtein(lower(trim(concat_ws(' ', u.model_name, u.variant))), lower(trim(concat_ws(' ', d.dv_model, d.dv_variant)))) AS dist
      FROM unresolved u JOIN dv d
        ON substr(lower(trim(concat_ws(' ', u.model_name, u.variant))), 1, 2) = substr(d.dv_model, 1, 2)
       AND u.MAKE_YEAR_KEY = d.dv_make_year"""),
    ("fz", f"""SELECT reg_no, dv_id, dist FROM (
        SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY dist, dv_id) AS _rn FROM cand
        WHERE dist <= {R.DEFAULT_FUZZY_THRESHOLD}) WHERE _rn = 1"""),
    ("resmap", """SELECT reg_no, VEHICLE_ID_resolved, CAST(NULL AS INTEGER) AS LEV_DIST, false AS IS_FUZZY_MATCH FROM exact
      UNION ALL SELECT reg_no, dv_id, CAST(dist AS INTEGER), true FROM fz"""),
    ("fact", """SELECT * FROM (SELECT coalesce(m.VEHICLE_ID_resolved, s.VEHICLE_ID) AS VEHICLE_ID,
        s.MANUFACTURER_ID AS MANUFACTURER_ID, s.RTA_ID AS RTA_ID,
        CAST(strftime(s.from_date_parsed, '%Y%m%d') AS INTEGER) AS REGISTRATION_ISSUE_DATE_ID,
        CAST(strftime(s.to_date_parsed, '%Y%m%d') AS INTEGER) AS REGISTRATION_EXPIRY_DATE_ID,
        CAST(year(s.from_date_parsed) AS INTEGER) AS REGISTRATION_YEAR,
        s.vehicle_class AS TRANSPORT_TYPE, s.reg_no AS TEMP_REGISTRATION_NUMBER, s.slno AS SLNO,
        coalesce(m.IS_FUZZY_MATCH, false) AS IS_FUZZY_MATCH, s.colour AS COLOUR, s.fuel_clean AS FUEL_TYPE,
        s.model_name AS MODEL_NAME, s.emission_standard AS EMISSION_STANDARD
      FROM staged s LEFT JOIN resmap m ON s.reg_no = m.reg_no) WHERE REGISTRATION_ISSUE_DATE_ID IS NOT NULL"""),
    # row-level derivations over the whole dirty view
    *repair_ctes("dirty", "d"),
    *token_ctes("dirty", "d"),
    *parse_ctes("dirty", "d"),
]


def with_chain(final: str, extra: list[tuple[str, str]] = ()) -> str:
    ctes = ",\n".join(f"{name} AS (\n{body}\n)" for name, body in [*CHAIN, *extra])
    return f"WITH {ctes}\n{final}"


#: two halves of the dirty view that share no key
HALVES = ("regexp_matches(coalesce(reg_no, ''), '[02468]$')", "NOT regexp_matches(coalesce(reg_no, ''), '[02468]$')")


def with_half(half: str, final: str, known: str | None = None) -> str:
    """``with_chain`` over the rows of one half only; ``known`` gives vehicles to resolve against besides its own."""
    chain = CHAIN[1:]
    if known:
        both = "(SELECT * FROM earlier UNION ALL SELECT * FROM dim_vehicle WHERE VEHICLE_ID NOT IN (SELECT VEHICLE_ID FROM earlier))"
        chain = [(n, body.replace("FROM dim_vehicle", f"FROM {both}") if n == "dv" else body) for n, body in chain]
        chain = [("earlier", f"SELECT * FROM {known}"), *chain]
    ctes = [("whole", DIRTY_SQL), ("dirty", f"SELECT * FROM whole WHERE {half}"), *chain]
    return "(WITH " + ",\n".join(f"{name} AS (\n{body}\n)" for name, body in ctes) + f"\n{final})"


def _metric_rows(pairs: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT '{m}' AS metric, CAST(({q}) AS BIGINT) AS value" for m, q in pairs)


PIPELINE_METRICS = [
    ("input_rows", "SELECT count(*) FROM dirty"),
    ("missing_key", "SELECT count(*) FROM dirty WHERE reg_no IS NULL OR trim(reg_no) = ''"),
    ("duplicates_removed", "SELECT count(*) FROM removed"),
    ("after_dedupe", "SELECT count(*) FROM kept"),
    ("invalid_dates", "SELECT count(*) FROM invalid"),
    ("staged_rows", "SELECT count(*) FROM staged"),
    ("dim_vehicle_rows", "SELECT count(*) FROM dim_vehicle"),
    ("dim_manufacturer_rows", "SELECT count(*) FROM dim_manufacturer"),
    ("dim_rta_rows", "SELECT count(*) FROM dim_office"),
    ("exact_matches", "SELECT count(*) FROM exact"),
    ("fuzzy_matches", "SELECT count(*) FROM fz"),
    ("total_resolved", "SELECT count(*) FROM resmap"),
    ("fact_rows", "SELECT count(*) FROM fact"),
]

FACT_COLS = ("VEHICLE_ID, MANUFACTURER_ID, RTA_ID, REGISTRATION_ISSUE_DATE_ID, REGISTRATION_EXPIRY_DATE_ID, "
             "REGISTRATION_YEAR, TRANSPORT_TYPE, TEMP_REGISTRATION_NUMBER, SLNO, IS_FUZZY_MATCH, COLOUR, "
             "FUEL_TYPE, MODEL_NAME, EMISSION_STANDARD")

REJECTS = f"""SELECT {RAW}, 'missing_key' AS reject_reason FROM dirty WHERE reg_no IS NULL OR trim(reg_no) = ''
  UNION ALL SELECT {RAW}, 'duplicate' FROM removed
  UNION ALL SELECT {RAW}, 'invalid_date' FROM invalid"""


def _checked_failed(src: str, failed_cond: str, checked: str = "count(*)") -> str:
    return (f"SELECT CAST({checked} AS BIGINT) AS checked, "
            f"CAST(count(*) FILTER (WHERE coalesce({failed_cond}, false)) AS BIGINT) AS failed FROM {src}")


def _orphans(fk: str, src: str, dim: str, dim_key: str) -> str:
    return (f"SELECT '{fk}' AS foreign_key, CAST(count(*) AS BIGINT) AS checked, "
            f"CAST(count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{dim_key} = f.{fk})) AS BIGINT) AS failed "
            f"FROM {src} f")


def _unique(dim: str, key: str) -> str:
    return (f"SELECT '{dim}' AS dim, CAST(sum(n) AS BIGINT) AS checked, "
            f"CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS duplicated_ids, "
            f"CAST(coalesce(sum(CASE WHEN {key} IS NULL THEN n END), 0) AS BIGINT) AS null_ids "
            f"FROM (SELECT {key}, count(*) AS n FROM {dim} GROUP BY {key})")


EXTERNAL_RESOLUTION = [
    ("pdim", """SELECT 'P' || CAST(p_partkey AS VARCHAR) AS VEHICLE_ID,
        upper(split_part(p_name, ' ', 1)) AS MODEL_NAME,
        upper(concat_ws(' ', split_part(p_name, ' ', 2), p_type)) AS VARIANT,
        CAST(1990 + p_size % 30 AS VARCHAR) AS MAKE_YEAR FROM part"""),
    ("xdv", """SELECT VEHICLE_ID AS dv_id, lower(trim(MODEL_NAME)) AS dv_model, lower(trim(VARIANT)) AS dv_variant,
        MAKE_YEAR AS dv_make_year FROM pdim"""),
    ("xexact", """SELECT s.reg_no, d.dv_id AS VEHICLE_ID_resolved FROM sm s JOIN xdv d
        ON lower(trim(s.model_name)) = d.dv_model AND lower(trim(s.variant)) = d.dv_variant AND s.MAKE_YEAR_KEY = d.dv_make_year"""),
    ("xunresolved", "SELECT * FROM sm s WHERE NOT EXISTS (SELECT 1 FROM xexact e WHERE e.reg_no = s.reg_no)"),
    ("xcand", """SELECT u.reg_no, d.dv_id,
        levenshtein(lower(trim(concat_ws(' ', u.model_name, u.variant))), lower(trim(concat_ws(' ', d.dv_model, d.dv_variant)))) AS dist
      FROM xunresolved u JOIN xdv d
        ON substr(lower(trim(concat_ws(' ', u.model_name, u.variant))), 1, 2) = substr(d.dv_model, 1, 2)
       AND u.MAKE_YEAR_KEY = d.dv_make_year"""),
    ("xfz", f"""SELECT reg_no, dv_id, dist FROM (
        SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY dist, dv_id) AS _rn FROM xcand
        WHERE dist <= {R.DEFAULT_FUZZY_THRESHOLD}) WHERE _rn = 1"""),
]

HOT = [("hot", """SELECT * REPLACE (CASE WHEN fuel IN ('DIESEL', 'Diesel', 'LPG') THEN 'HOT' ELSE reg_no END AS reg_no)
    FROM dirty""")]

ORACLES: dict[str, str] = {
    "missing_key": with_chain("SELECT * FROM dirty WHERE reg_no IS NULL OR trim(reg_no) = ''"),
    "valid_key": with_chain("SELECT * FROM valid"),
    "latest_per_key": with_chain("SELECT * FROM kept"),
    "duplicates_removed": with_chain("SELECT * FROM removed"),
    "hot_key_latest": with_chain(f"""SELECT * EXCLUDE (_rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY {ORDER_KEEP}) AS _rn FROM hot
        WHERE NOT (reg_no IS NULL OR trim(reg_no) = '')) WHERE _rn = 1""", HOT),
    "hot_key_duplicates": with_chain(f"""SELECT * EXCLUDE (_rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY {ORDER_KEEP}) AS _rn FROM hot
        WHERE NOT (reg_no IS NULL OR trim(reg_no) = '')) WHERE _rn > 1""", HOT),
    "latest_valid_per_key": with_chain(
        f"""SELECT * EXCLUDE (_rn, _pd) FROM (
              SELECT *, row_number() OVER (PARTITION BY reg_no ORDER BY _pd DESC NULLS LAST, {ORDER_KEEP}) AS _rn
              FROM (SELECT *, {_date_case(_date_clean('from_date'))} AS _pd FROM valid)) WHERE _rn = 1"""),
    "first_line_per_part": """SELECT * EXCLUDE (_rn), _rn = 1 AS is_kept FROM (
        SELECT *, row_number() OVER (PARTITION BY part_key ORDER BY l_shipdate DESC NULLS LAST, l_orderkey ASC NULLS FIRST,
                                     l_linenumber ASC NULLS FIRST) AS _rn
        FROM (SELECT CASE WHEN l_quantity >= 5 THEN l_partkey END AS part_key, l_shipdate, l_orderkey, l_linenumber FROM lineitem))""",
    "parse_mixed_dates": with_chain(f"SELECT {IDS}, from_date, to_date_raw, from_date_parsed, to_date_parsed FROM dparsed"),
    "invalid_dates": with_chain(f"SELECT {RAW} FROM invalid"),
    "office_repair": with_chain(f"SELECT {IDS}, office_cd, from_date FROM drep3"),
    "model_tokens": with_chain(
        f"SELECT {IDS}, model_desc, model_clean, is_trailer, is_electric, model_name, variant FROM dtok4"),
    "fuel_class": with_chain(f"SELECT {IDS}, fuel, {_fuel_case('fuel', R.FUEL_RULES)} AS fuel_clean FROM dirty"),
    "fuel_class_ci": with_chain(f"SELECT {IDS}, fuel, {_fuel_case('fuel', R.FUEL_RULES_CI)} AS fuel_clean FROM dirty"),
    "make_year_backfill": with_chain(f"SELECT {IDS}, model_clean, make_year FROM ({backfill_sql('dtok4')})"),
    "emission_standard": with_chain(
        f"SELECT {IDS}, model_clean, is_electric, emission_standard FROM ({emission_sql('dtok4')})"),
    "emission_standard_fixed": with_chain(
        f"SELECT {IDS}, model_clean, is_electric, emission_standard FROM ({emission_sql('dtok4', R.EMISSION_PATTERN_FIXED)})"),
    "date_parts": """SELECT o_orderkey, CAST(year(CAST(o_orderdate AS DATE)) AS INTEGER) AS year,
        CAST(month(CAST(o_orderdate AS DATE)) AS INTEGER) AS month FROM orders""",
    "date_id": """SELECT o_orderkey, CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS order_date_id
        FROM orders""",
    "stage_registrations": with_chain(
        f"""SELECT {IDS}, office_cd, from_date, from_date_parsed, to_date_parsed, model_clean, model_name, variant,
            is_trailer, is_electric, fuel_clean, make_year, year, month FROM staged"""),
    "surrogate_keys": with_chain(
        "SELECT reg_no, emission_standard, MAKE_YEAR_KEY, VEHICLE_ID, MANUFACTURER_ID, RTA_ID FROM staged"),
    "dim_vehicle": with_chain("SELECT * FROM dim_vehicle"),
    "dim_manufacturer": with_chain("SELECT * FROM dim_manufacturer"),
    "dim_office": with_chain("SELECT * FROM dim_office"),
    "exact_match": with_chain("SELECT reg_no, VEHICLE_ID_resolved FROM exact"),
    "unresolved_keys": with_chain("SELECT reg_no FROM unresolved"),
    "fuzzy_match_best": f"""
        WITH probe AS (SELECT p_partkey, replace(p_name, 'e', '') AS probe_name FROM part),
        names AS (SELECT DISTINCT p_name AS matched_name FROM part),
        cand AS (SELECT p.p_partkey, p.probe_name, n.matched_name, levenshtein(p.probe_name, n.matched_name) AS lev_dist
                 FROM probe p JOIN names n ON substr(p.probe_name, 1, 2) = substr(n.matched_name, 1, 2))
        SELECT p_partkey, probe_name, matched_name, CAST(lev_dist AS INTEGER) AS lev_dist FROM (
          SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY lev_dist, matched_name) AS _rn
          FROM cand WHERE lev_dist <= {R.DEFAULT_FUZZY_THRESHOLD}) WHERE _rn = 1""",
    "resolution_map": with_chain("SELECT * FROM resmap"),
    "resolution_external": with_chain(
        """SELECT reg_no, VEHICLE_ID_resolved, CAST(NULL AS INTEGER) AS LEV_DIST, false AS IS_FUZZY_MATCH FROM xexact
           UNION ALL SELECT reg_no, dv_id, CAST(dist AS INTEGER), true FROM xfz""", EXTERNAL_RESOLUTION),
    "fact_registrations": with_chain("SELECT * FROM fact"),
    "misalignment": with_chain(f"""
        SELECT CAST(count(*) AS BIGINT) AS total_rows,
          CAST(count(*) FILTER (WHERE k = 'Type 1') AS BIGINT) AS type1_rows,
          CAST(count(*) FILTER (WHERE k = 'Type 2') AS BIGINT) AS type2_rows,
          CAST(count(*) FILTER (WHERE k = 'Type 3') AS BIGINT) AS type3_rows,
          CAST(count(*) FILTER (WHERE k = 'Clean') AS BIGINT) AS clean_rows,
          CAST(100.0 AS DOUBLE) * (count(*) - count(*) FILTER (WHERE k = 'Clean')) / count(*) AS misaligned_pct
        FROM (SELECT CASE
            WHEN NOT regexp_matches(to_date_raw, '{R.MISALIGN_EXPIRY_SHAPE}') THEN 'Type 1'
            WHEN regexp_matches(regexp_replace(model_desc, '{R.MODEL_SCRUB_PATTERN}', ' ', 'g'), '{R.MISALIGN_TEXT_PATTERN}') THEN 'Type 2'
            WHEN maker_name IS NULL OR colour IS NULL THEN 'Type 3'
            ELSE 'Clean' END AS k FROM dirty)"""),
    "prepost_metrics": with_chain(f"""
        SELECT 'pre' AS stage, CAST(count(*) AS BIGINT) AS total_rows,
               CAST(count(*) FILTER (WHERE maker_name IS NULL) AS BIGINT) AS null_maker,
               CAST(NULL AS BIGINT) AS valid_dates, CAST(NULL AS BIGINT) AS misaligned_rows FROM dirty
        UNION ALL
        SELECT 'post', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE maker_name IS NULL) AS BIGINT),
               CAST(count(*) FILTER (WHERE from_date_parsed IS NOT NULL) AS BIGINT),
               CAST(count(*) FILTER (WHERE k <> 'Clean') AS BIGINT)
        FROM (SELECT *, CASE
            WHEN NOT regexp_matches(to_date_raw, '{R.MISALIGN_EXPIRY_SHAPE}') THEN 'Type 1'
            WHEN regexp_matches(regexp_replace(model_desc, '{R.MODEL_SCRUB_PATTERN}', ' ', 'g'), '{R.MISALIGN_TEXT_PATTERN}') THEN 'Type 2'
            WHEN maker_name IS NULL OR colour IS NULL THEN 'Type 3'
            ELSE 'Clean' END AS k FROM dparsed)"""),
    "dq_key_determinism": with_chain("""
        SELECT CAST(count(*) AS BIGINT) AS checked, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS failed FROM (
          SELECT count(DISTINCT VEHICLE_ID) AS n FROM staged
          GROUP BY lower(trim(model_name)), lower(trim(variant)), MAKE_YEAR_KEY)"""),
    "dq_unique": with_chain(f"""{_unique('dim_vehicle', 'VEHICLE_ID')}
        UNION ALL {_unique('dim_manufacturer', 'MANUFACTURER_ID')}
        UNION ALL {_unique('dim_office', 'RTA_ID')}"""),
    "dq_domain": with_chain(_checked_failed(
        "staged", "NOT list_contains(['BSIII', 'BSIV', 'BSVI', 'ELECTRIC', 'UNKNOWN'], emission_standard)")),
    "dq_threshold": with_chain(
        "SELECT CAST(count(*) FILTER (WHERE IS_FUZZY_MATCH) AS BIGINT) AS checked, "
        f"CAST(count(*) FILTER (WHERE IS_FUZZY_MATCH AND LEV_DIST > {R.DEFAULT_FUZZY_THRESHOLD}) AS BIGINT) AS failed "
        "FROM resmap"),
    "dq_fk_null": with_chain(_checked_failed("fact", "VEHICLE_ID IS NULL OR RTA_ID IS NULL")),
    "dq_date_key": with_chain(_checked_failed(
        "fact", "REGISTRATION_ISSUE_DATE_ID IS NULL OR length(CAST(REGISTRATION_ISSUE_DATE_ID AS VARCHAR)) <> 8")),
    "dq_fk_orphans": with_chain(f"""{_orphans('VEHICLE_ID', 'fact', 'dim_vehicle', 'VEHICLE_ID')}
        UNION ALL {_orphans('MANUFACTURER_ID', 'fact', 'dim_manufacturer', 'MANUFACTURER_ID')}
        UNION ALL {_orphans('RTA_ID', 'fact', 'dim_office', 'RTA_ID')}"""),
    "dq_fk_orphans_orders": _orphans(
        "o_custkey", "orders", "(SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')", "c_custkey"),
    "parquet_roundtrip": "SELECT * FROM orders",
    "csv_roundtrip": with_chain("SELECT * FROM dirty"),
    "partitioned_roundtrip": "SELECT * FROM orders",
    "sized_write_roundtrip": "SELECT * FROM lineitem",
    "quarantine_roundtrip": with_chain(REJECTS),
    "star_roundtrip": with_chain(f"SELECT {FACT_COLS} FROM fact"),
    "append_fact": f"""SELECT * FROM {with_half(HALVES[0], f"SELECT {FACT_COLS} FROM fact")}
        UNION ALL SELECT * FROM {with_half(HALVES[1], f"SELECT {FACT_COLS} FROM fact")}""",
    "append_repeated": f"""SELECT *, CAST(2 AS BIGINT) AS n_parts FROM (SELECT * FROM {with_half(HALVES[0], f"SELECT {FACT_COLS} FROM fact")}
        UNION ALL SELECT * FROM {with_half(HALVES[1], f"SELECT {FACT_COLS} FROM fact")})""",
    "append_resolution": f"""SELECT * FROM {with_half(HALVES[0], f"SELECT {FACT_COLS} FROM fact")}
        UNION ALL SELECT * FROM {with_half(HALVES[1], f"SELECT {FACT_COLS} FROM fact", known=with_half(HALVES[0], "SELECT * FROM dim_vehicle"))}""",
    "csv_bad_rows": """
        SELECT CASE WHEN good THEN key END AS key, CASE WHEN good THEN status END AS status, CASE WHEN good THEN coalesce(buyer, extra) END AS customer,
          CASE WHEN NOT good THEN concat_ws(',', key, status, buyer, extra) END AS bad_row
        FROM (SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderkey % 13 = 0 THEN '"' ELSE '' END || o_orderstatus AS status,
            CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS buyer,
            CASE WHEN o_orderkey % 11 = 0 THEN 'more' END AS extra,
            (o_orderkey % 7 <> 0) <> (o_orderkey % 11 = 0) AND o_orderkey % 13 <> 0 AS good FROM orders)""",
    "append_dim_vehicle": f"""WITH a AS (SELECT * FROM {with_half(HALVES[0], "SELECT * FROM dim_vehicle")}),
        b AS (SELECT * FROM {with_half(HALVES[1], "SELECT * FROM dim_vehicle")})
        SELECT * FROM a UNION ALL SELECT * FROM b WHERE VEHICLE_ID NOT IN (SELECT VEHICLE_ID FROM a)""",
    "dir_ingest": with_chain("SELECT * FROM dirty"),
    "ingest_status": """
        SELECT 'parquet' AS file_format, CAST(count(*) AS BIGINT) AS rows, 'ok' AS status, false AS has_error FROM nation
        UNION ALL SELECT 'csv', CAST(count(*) AS BIGINT), 'ok', false FROM region
        UNION ALL SELECT 'parquet', CAST(0 AS BIGINT), 'empty', false
        UNION ALL SELECT 'parquet', CAST(0 AS BIGINT), 'failed', true""",
    "compressed_csv_roundtrip": "SELECT * FROM orders",
    "output_size_audit": "SELECT count(*) AS rows, true AS files_agree, true AS bytes_agree FROM lineitem",
    "preview": with_chain(
        "SELECT * FROM dirty ORDER BY reg_no ASC NULLS FIRST, from_date ASC NULLS FIRST, slno, pk, sk, qty LIMIT 20"),
    "etl_counts": with_chain(_metric_rows(PIPELINE_METRICS)),
    "run_metrics": with_chain(_metric_rows(PIPELINE_METRICS)),
}
# the same rows by another plan
ORACLES["duplicates_removed_at"] = ORACLES["duplicates_removed"]
ORACLES["hot_key_duplicates_at"] = ORACLES["hot_key_duplicates"]
ORACLES["first_line_per_part_at"] = ORACLES["first_line_per_part"]
