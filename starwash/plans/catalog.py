"""Registered queries: one Spark plan per operator of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
driver tables at ``sf_dir`` (the ``dirty`` view covers all of lineitem).
Queries named ``*_roundtrip`` and the ingest queries write to a fresh folder
under the shared root first and return the read-back frame.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions import rules as R
from ..operators import clean as C
from ..operators import dims as D
from ..operators import quality as Q
from ..operators import stage as S
from ..operators.dedupe import FIRST, By, keep_latest, mark_first_at
from ..operators.fact import FACT_COLUMNS, assemble_fact, match_counts
from ..operators.resolve import (
    VEHICLE,
    best_match,
    registration_map,
    resolve_vehicles,
    similar_pairs,
    vehicle_join_condition,
)
from ..schema import BAD_ROW
from ..session import work_path
from ..sources import readers, sinks
from ..sources.publish import current, read_published
from .fixtures import DIRTY_RAW, DIRTY_TIE_BREAK, dirty, table
from .pipeline import FACT, run_registrations_etl

IDS = ["reg_no", "slno", "pk", "sk", "qty"]
OPTS = S.CleanOptions(tie_break=DIRTY_TIE_BREAK)

# Declared schema of the dirty registrations when read back from CSV.
DIRTY_SCHEMA = StructType(
    [StructField(n, StringType()) for n in DIRTY_RAW[:12]]
    + [StructField("pk", LongType()), StructField("sk", LongType()), StructField("qty", DoubleType())]
)

Query = Callable[[SparkSession, str], DataFrame]

# Null marker for CSV files this module writes and reads back (keeps '' apart from null).
NULL_MARK = "\\N"


# ---- shared building blocks ------------------------------------------------------

def _staged(spark, sf, opts=OPTS):
    res = S.clean_and_stage(dirty(spark, sf), opts)
    return res, S.star_columns(res.staged, opts)


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back (cuts the lineage,
    so several consumers do not each recompute it)."""
    return sinks.write_then_read(df, work_path(df.sparkSession, name))


def _staged_table(spark, sf):
    """Staged rows with star columns, written once (for chains with several consumers)."""
    return _written(_staged(spark, sf)[1], "staged")


def _tagged_table(spark, sf):
    """All rows of the dirty view with their reasons, written once by reason."""
    raw = dirty(spark, sf)
    return S.write_tagged(raw, work_path(spark, "tagged"), S.spread_known(raw, OPTS))


def _chain(spark, sf):
    """Staged rows, dimensions and the vehicle map for the dirty view."""
    staged = _staged_table(spark, sf)
    dims = D.build_dimensions(staged)
    vmap = _written(resolve_vehicles(staged, dims.vehicle), "vehicle-map")
    return staged, dims, vmap


def _fact(spark, sf):
    staged, dims, vmap = _chain(spark, sf)
    return assemble_fact(staged, vmap), dims, vmap, staged


def _tokens(spark, sf):
    return C.model_tokens(dirty(spark, sf))


# ---- filters, dedupe, derivations ---------------------------------------------------

def q_missing_key(spark, sf):
    return C.missing_key(dirty(spark, sf))


def q_valid_key(spark, sf):
    return C.valid_key(dirty(spark, sf))


def _landed(df: DataFrame) -> DataFrame:
    """The rows as files, which have addresses (the view is a join)."""
    return _written(df, "landed")


AT = replace(OPTS, row_addresses=True)


def q_latest_per_key(spark, sf):
    return S.dedupe(dirty(spark, sf), OPTS)[1]


def q_duplicates_removed(spark, sf):
    return S.dedupe(dirty(spark, sf), OPTS)[2]


def q_duplicates_removed_at(spark, sf):
    """The same by row addresses."""
    return S.dedupe(_landed(dirty(spark, sf)), AT)[2]


HOT_KEY = "HOT"


def _hot_dirty(spark, sf):
    """The dirty view with every DIESEL/Diesel/LPG row (about 3/8 of all rows)
    under one registration key: a hot key for the dedupe."""
    d = dirty(spark, sf)
    return d.withColumn("reg_no", F.when(F.col("fuel").isin("DIESEL", "Diesel", "LPG"), F.lit(HOT_KEY))
                        .otherwise(F.col("reg_no")))


def q_hot_key_latest(spark, sf):
    return S.dedupe(_hot_dirty(spark, sf), OPTS)[1]


def q_hot_key_duplicates(spark, sf):
    return S.dedupe(_hot_dirty(spark, sf), OPTS)[2]


def q_hot_key_duplicates_at(spark, sf):
    return S.dedupe(_landed(_hot_dirty(spark, sf)), AT)[2]


def q_first_line_per_part_at(spark, sf):
    """All rows of lineitem by their own addresses, with a mark on the first of each nullable key."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") >= 5, F.col("l_partkey")).alias("part_key"),
        "l_shipdate", "l_orderkey", "l_linenumber")
    return mark_first_at(lines, "part_key", [By(F.col("l_shipdate"), desc=True)]).withColumnRenamed(FIRST, "is_kept")


def q_first_line_per_part(spark, sf):
    """Keep-latest on a nullable bigint key: all rows, with a mark on the kept ones."""
    lines = table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") >= 5, F.col("l_partkey")).alias("part_key"),
        "l_shipdate", "l_orderkey", "l_linenumber")
    kept, removed = keep_latest(lines, "part_key", [F.col("l_shipdate").desc_nulls_last()])
    return kept.withColumn("is_kept", F.lit(True)).unionByName(removed.withColumn("is_kept", F.lit(False)))


def q_latest_valid_per_key(spark, sf):
    opts = S.CleanOptions(tie_break=DIRTY_TIE_BREAK, dedupe_order="latest_valid")
    return S.dedupe(dirty(spark, sf), opts)[1]


def q_parse_mixed_dates(spark, sf):
    return C.parse_dates(dirty(spark, sf)).select(
        *IDS, "from_date", "to_date_raw", "from_date_parsed", "to_date_parsed")


def q_invalid_dates(spark, sf):
    res, _ = _staged(spark, sf)
    return res.invalid.select(*DIRTY_RAW)


def q_office_repair(spark, sf):
    return C.repair_office(dirty(spark, sf)).select(*IDS, "office_cd", "from_date")


def q_model_tokens(spark, sf):
    return _tokens(spark, sf).select(
        *IDS, "model_desc", "model_clean", "is_trailer", "is_electric", "model_name", "variant")


def q_fuel_class(spark, sf):
    return C.classify_fuel(dirty(spark, sf)).select(*IDS, "fuel", "fuel_clean")


def q_fuel_class_ci(spark, sf):
    return C.classify_fuel(dirty(spark, sf), rules=R.FUEL_RULES_CI).select(*IDS, "fuel", "fuel_clean")


def q_make_year_backfill(spark, sf):
    return C.backfill_make_year(_tokens(spark, sf)).select(*IDS, "model_clean", "make_year")


def q_emission_standard(spark, sf):
    return C.emission_standard(_tokens(spark, sf)).select(*IDS, "model_clean", "is_electric", "emission_standard")


def q_emission_standard_fixed(spark, sf):
    out = C.emission_standard(_tokens(spark, sf), pattern=R.EMISSION_PATTERN_FIXED)
    return out.select(*IDS, "model_clean", "is_electric", "emission_standard")


def q_date_parts(spark, sf):
    return C.date_parts(table(spark, sf, "orders"), "o_orderdate").select("o_orderkey", "year", "month")


def q_date_id(spark, sf):
    from ..operators.keys import date_ids
    return date_ids(table(spark, sf, "orders"), {"order_date_id": "o_orderdate"}).select("o_orderkey", "order_date_id")


def q_stage_registrations(spark, sf):
    res, _ = _staged(spark, sf)
    return res.staged.select(
        *IDS, "office_cd", "from_date", "from_date_parsed", "to_date_parsed", "model_clean", "model_name", "variant",
        "is_trailer", "is_electric", "fuel_clean", "make_year", "year", "month")


def q_surrogate_keys(spark, sf):
    _, staged = _staged(spark, sf)
    return staged.select("reg_no", "emission_standard", "MAKE_YEAR_KEY", "VEHICLE_ID", "MANUFACTURER_ID", "RTA_ID")


# ---- dimensions, resolution, fact -------------------------------------------------------

def q_dim_vehicle(spark, sf):
    return D.dim_vehicle(_staged(spark, sf)[1])


def q_dim_manufacturer(spark, sf):
    return D.dim_manufacturer(_staged(spark, sf)[1])


def q_dim_office(spark, sf):
    return D.dim_office(_staged(spark, sf)[1])


def q_exact_match(spark, sf):
    staged, _, vmap = _chain(spark, sf)
    return registration_map(staged, vmap.filter(~F.col("IS_FUZZY_MATCH"))).select("reg_no", "VEHICLE_ID_resolved")


def q_unresolved_keys(spark, sf):
    staged, _, vmap = _chain(spark, sf)
    exact = vmap.filter(~F.col("IS_FUZZY_MATCH")).select(*VEHICLE).distinct().alias("e")
    s = staged.select("reg_no", *VEHICLE).alias("s")
    return s.join(exact, vehicle_join_condition("s", "e"), "left_anti").select("reg_no")


def q_fuzzy_match_best(spark, sf):
    part = table(spark, sf, "part")
    parts = part.select("p_partkey", F.regexp_replace("p_name", "e", "").alias("probe_name"))
    # each distinct name is looked up once, however many parts have it
    probe = parts.select("probe_name").distinct().withColumn("probe_block", F.col("probe_name").substr(1, 2))
    names = part.select(F.col("p_name").alias("matched_name")).distinct().withColumn(
        "name_block", F.col("matched_name").substr(1, 2))
    block = ("probe_block", "name_block")
    pairs = similar_pairs(probe, names, left_text="probe_name", right_text="matched_name", keys=[block], prefix=block,
                          dist_col="lev_dist")
    return parts.join(best_match(pairs, ["probe_name"], "matched_name", dist_col="lev_dist"), "probe_name").select(
        "p_partkey", "probe_name", "matched_name", "lev_dist")


def q_resolution_map(spark, sf):
    staged, _, vmap = _chain(spark, sf)
    return registration_map(staged, vmap)


def part_vehicle_dim(spark, sf) -> DataFrame:
    """An external vehicle dimension derived from ``part`` (one row per part, so a
    (model, variant, year) can carry several ids and fan out, as an external
    reference may)."""
    part = table(spark, sf, "part")
    words = F.split("p_name", " ")
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("VEHICLE_ID"),
        F.upper(words.getItem(0)).alias("MODEL_NAME"),
        F.upper(F.concat_ws(" ", words.getItem(1), F.col("p_type"))).alias("VARIANT"),
        (F.lit(1990) + F.col("p_size") % 30).cast("string").alias("MAKE_YEAR"),
    )


def q_resolution_external(spark, sf):
    staged = _staged_table(spark, sf)
    vmap = _written(resolve_vehicles(staged, part_vehicle_dim(spark, sf)), "vehicle-map-ext")
    return registration_map(staged, vmap)


def q_fact_registrations(spark, sf):
    return _fact(spark, sf)[0]


# ---- quality ------------------------------------------------------------------------------

def _classified(spark, sf):
    return C.misalignment(C.repair_office(C.parse_dates(dirty(spark, sf))))


def q_misalignment(spark, sf):
    return Q.misalignment_summary(_classified(spark, sf))


def q_prepost_metrics(spark, sf):
    return Q.prepost_metrics(dirty(spark, sf), _classified(spark, sf))


def q_dq_key_determinism(spark, sf):
    return Q.vehicle_key_determinism(_staged(spark, sf)[1])


def q_dq_unique(spark, sf):
    dims = D.build_dimensions(_staged(spark, sf)[1])
    parts = [Q.unique_not_null(frame, key).select(F.lit(name).alias("dim"), "*")
             for name, frame, key in (("dim_vehicle", dims.vehicle, "VEHICLE_ID"),
                                      ("dim_manufacturer", dims.manufacturer, "MANUFACTURER_ID"),
                                      ("dim_office", dims.office, "RTA_ID"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_dq_domain(spark, sf):
    return Q.value_domain(_staged(spark, sf)[1], "emission_standard")


def q_dq_threshold(spark, sf):
    staged, _, vmap = _chain(spark, sf)
    return Q.distance_within(registration_map(staged, vmap))


def q_dq_fk_null(spark, sf):
    return Q.mandatory_keys(_fact(spark, sf)[0])


def q_dq_date_key(spark, sf):
    return Q.date_key_format(_fact(spark, sf)[0])


def q_dq_fk_orphans(spark, sf):
    fact, dims, _, _ = _fact(spark, sf)
    return Q.referential_integrity(fact, {"VEHICLE_ID": dims.vehicle, "MANUFACTURER_ID": dims.manufacturer,
                                          "RTA_ID": dims.office})


def q_dq_fk_orphans_orders(spark, sf):
    customers = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    return Q.orphans(table(spark, sf, "orders"), customers, "o_custkey", "c_custkey")


# ---- sources and sinks (write, then read back) ------------------------------------------------

def q_parquet_roundtrip(spark, sf):
    path = work_path(spark, "orders-parquet")
    sinks.write_parquet(table(spark, sf, "orders"), path)
    return readers.read_parquet(spark, path)


def q_csv_roundtrip(spark, sf):
    path = work_path(spark, "dirty-csv")
    sinks.write_csv(dirty(spark, sf), path, null_value=NULL_MARK)
    return readers.read_csv(spark, path, DIRTY_SCHEMA, nullValue=NULL_MARK)


def q_partitioned_roundtrip(spark, sf):
    path = work_path(spark, "orders-by-status")
    sinks.write_parquet(table(spark, sf, "orders"), path, partition_by=["o_orderstatus"])
    return readers.read_parquet(spark, path)


def q_sized_write_roundtrip(spark, sf):
    path = work_path(spark, "lineitem-sized")
    sinks.write_sized(table(spark, sf, "lineitem"), path, partition_by=["l_returnflag"], target_mb=1.0)
    return readers.read_parquet(spark, path)


def q_quarantine_roundtrip(spark, sf):
    path = work_path(spark, "quarantine")
    tagged = _tagged_table(spark, sf)
    sinks.write_rejects(S.quarantine(tagged, list(DIRTY_RAW)), path, from_files=True)
    return readers.read_parquet(spark, path)


def _etl_run(spark, sf):
    root = work_path(spark, "star")
    metrics = run_registrations_etl(dirty(spark, sf), output_root=root, options=OPTS, conform_input=False)
    return root, metrics


def q_star_roundtrip(spark, sf):
    root, _ = _etl_run(spark, sf)
    return read_published(spark, root, FACT).select(*FACT_COLUMNS)


def q_run_metrics(spark, sf):
    root, _ = _etl_run(spark, sf)
    runs = spark.read.json(f"{root}/metrics")
    counts = F.from_json("counts_json", "map<string,bigint>")
    return runs.select(F.explode(counts).alias("metric", "value"))


def _append_halves(spark, sf, again=False, **how):
    """Two runs over halves that share no key, the second appended to the first; ``again``: and the first once more."""
    root = work_path(spark, "star-append")
    d = dirty(spark, sf)
    even = F.coalesce(F.col("reg_no"), F.lit("")).rlike("[02468]$")
    for half in (even, ~even, even)[: 3 if again else 2]:
        run_registrations_etl(d.filter(half), output_root=root, options=OPTS, conform_input=False, mode="append", **how)
    return root


def q_append_repeated(spark, sf):
    """An input that is appended a second time adds nothing: fact rows, and the parts they are in."""
    root = _append_halves(spark, sf, again=True)
    parts = len(current(spark, root)["tables"][FACT]["parts"])
    return read_published(spark, root, FACT).select(*FACT_COLUMNS, F.lit(parts).cast("long").alias("n_parts"))


def q_append_resolution(spark, sf):
    """The second run's vehicles are resolved against those of both runs."""
    root = _append_halves(spark, sf, resolve_against="published")
    return read_published(spark, root, FACT).select(*FACT_COLUMNS)


def q_append_fact(spark, sf):
    return read_published(spark, _append_halves(spark, sf), FACT).select(*FACT_COLUMNS)


def q_append_dim_vehicle(spark, sf):
    return read_published(spark, _append_halves(spark, sf), "gold_dim_vehicle")


def _append(df: DataFrame, fmt: str, folder: str) -> None:
    """More files of a format in a folder that may have others."""
    w = df.write.mode("append")
    if fmt == "csv":
        w.options(**sinks.CSV_WRITE_OPTIONS).option("nullValue", NULL_MARK).csv(folder)
    else:
        w.format(fmt).save(folder)


def q_dir_ingest(spark, sf):
    folder = work_path(spark, "inbox")
    d = dirty(spark, sf)
    # some rows as parquet, the rest as csv, in one folder
    is_parquet = F.col("slno").isin("1", "2", "3")
    _append(d.filter(is_parquet), "parquet", folder)
    _append(d.filter(~is_parquet), "csv", folder)
    return readers.ingest_dir(spark, folder, DIRTY_SCHEMA, null_value=NULL_MARK)


def q_ingest_status(spark, sf):
    folder = work_path(spark, "inbox-status")
    _append(table(spark, sf, "nation"), "parquet", folder)
    _append(table(spark, sf, "region"), "csv", folder)
    # a readable file without rows
    _append(table(spark, sf, "region").limit(0), "parquet", folder)
    # an unreadable file with a parquet extension
    _put(spark, f"{folder}/broken.parquet", "\n".join(r[0] for r in table(spark, sf, "region").select("r_name").limit(5).collect()))
    st = readers.ingest_status(spark, folder, table(spark, sf, "region").schema)
    fmt = F.lower(F.regexp_extract("file_name", r"\.([^.]+)$", 1)).alias("file_format")
    return st.groupBy(fmt, "status", F.col("error").isNotNull().alias("has_error")).agg(F.sum("rows").cast("long").alias("rows"))


def _damaged_csv(spark, sf, folder: str) -> DataFrame:
    """Orders as lines of CSV, every 7th with a field missing, every 11th with one too many and every
    13th with a quote that is not closed, in files of a folder; returns the rows as read."""
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    line = F.concat_ws(",", k.cast("string"), F.when(k % 13 == 0, F.concat(F.lit('"'), "o_orderstatus")).otherwise(F.col("o_orderstatus")),
                       F.when(k % 7 != 0, F.col("o_custkey").cast("string")), F.when(k % 11 == 0, F.lit("more")))
    schema = StructType([StructField("key", StringType()), StructField("status", StringType()), StructField("customer", StringType())])
    o.select(line.alias("value")).write.text(folder)
    return readers.read_csv(spark, folder, schema, bad_rows=True, header="false")


def q_csv_bad_rows(spark, sf):
    """Rows that could not be parsed keep their text; all others are as written."""
    rows = _damaged_csv(spark, sf, work_path(spark, "damaged-csv"))
    good = F.col(BAD_ROW).isNull()
    return rows.select(*[F.when(good, F.col(c)).alias(c) for c in ("key", "status", "customer")], F.col(BAD_ROW).alias("bad_row"))


def _put(spark, path: str, text: str) -> None:
    """A small file of its own name."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    out.write(text.encode())
    out.close()


def q_compressed_csv_roundtrip(spark, sf):
    """The generic sink: gzip CSV into a given number of files, read back by name and type."""
    path = work_path(spark, "orders-csv-gz")
    orders = table(spark, sf, "orders")
    sinks.write_files(orders, "csv", path, n_files=4, compression="gzip")
    return readers.read_csv(spark, path, orders.schema)


def q_output_size_audit(spark, sf):
    """The audit's files and bytes against the sizes that the written files' own metadata states."""
    path = work_path(spark, "audit")
    sinks.write_parquet(table(spark, sf, "lineitem"), path, partition_by=["l_returnflag"])
    files, nbytes = sinks.audit_size(spark, path, "*.parquet")
    per_file = readers.read_parquet(spark, path).groupBy("_metadata.file_path").agg(
        F.count(F.lit(1)).alias("n"), F.max("_metadata.file_size").alias("size"))
    return per_file.agg(F.sum("n").alias("rows"), (F.count(F.lit(1)) == files).alias("files_agree"),
                        (F.sum("size") == nbytes).alias("bytes_agree"))


def q_preview(spark, sf):
    return readers.preview(dirty(spark, sf), ["reg_no", "from_date", "slno", "pk", "sk", "qty"])


def q_etl_counts(spark, sf):
    """Per-stage counts of the whole chain as (metric, value) rows.

    The tagged rows are written once; every count is then an aggregate over
    that table or over the dimensions, map and fact built from its staged part.
    """
    tagged = _tagged_table(spark, sf)
    reason = F.col(S.REJECT_REASON)
    by_reason = tagged.groupBy(reason).agg(F.count(F.lit(1)).alias("n"))

    def n_of(*reasons):
        return F.coalesce(F.sum(F.when(reason.isin(*reasons), F.col("n"))), F.lit(0))

    kept = n_of(S.INVALID_DATE, S.STAGED)
    reasons = by_reason.agg(
        F.sum("n").alias("input_rows"),
        n_of(S.MISSING_KEY).alias("missing_key"),
        n_of(S.DUPLICATE).alias("duplicates_removed"),
        kept.alias("after_dedupe"),
        n_of(S.INVALID_DATE).alias("invalid_dates"),
        n_of(S.STAGED).alias("staged_rows"),
    )
    names = ["input_rows", "missing_key", "duplicates_removed", "after_dedupe", "invalid_dates", "staged_rows"]
    out = reasons.select(F.explode(F.map_from_arrays(
        F.array(*[F.lit(x) for x in names]), F.array(*[F.col(x).cast("long") for x in names]))).alias("metric", "value"))

    staged = tagged.filter(reason == S.STAGED).drop(S.REJECT_REASON)
    dims = D.build_dimensions(staged)
    vmap = _written(resolve_vehicles(staged, dims.vehicle), "vehicle-map")
    fact = assemble_fact(staged, vmap)

    def n(name, df):
        return df.agg(F.count(F.lit(1)).cast("long").alias("value")).select(F.lit(name).alias("metric"), "value")

    matches = match_counts(staged, vmap)
    mnames = matches.columns
    for part in (n("dim_vehicle_rows", dims.vehicle), n("dim_manufacturer_rows", dims.manufacturer),
                 n("dim_rta_rows", dims.office), n("fact_rows", fact),
                 matches.select(F.explode(F.map_from_arrays(F.array(*[F.lit(x) for x in mnames]),
                                                            F.array(*[F.col(x).cast("long") for x in mnames])))
                                .alias("metric", "value"))):
        out = out.unionByName(part)
    return out


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
