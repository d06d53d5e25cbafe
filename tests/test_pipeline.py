"""End-to-end run on the dirty view at sf0.001: counts and properties."""

from pyspark.sql import functions as F

from starwash.plans import DIRTY_TIE_BREAK, dirty, run_registrations_etl
from starwash.operators.stage import CleanOptions
from starwash.session import work_path
from starwash.sources.publish import current, read_published, remove_unlisted

OPTS = CleanOptions(tie_break=DIRTY_TIE_BREAK)


def _run(spark, sf, **kw):
    root = work_path(spark, "t-star")
    return root, run_registrations_etl(dirty(spark, sf), output_root=root, options=OPTS, conform_input=False, **kw)


def test_etl_counts_and_properties(spark, sf_small):
    root, m = _run(spark, sf_small)
    c = m["counts"]
    assert c["input_rows"] == 6000
    assert c["missing_key"] == 130
    assert c["after_dedupe"] == 1442
    assert c["duplicates_removed"] == 4428
    assert c["invalid_dates"] == 377
    assert c["staged_rows"] == 1065
    assert c["dim_vehicle_rows"] == 180
    assert (c["exact_matches"], c["fuzzy_matches"]) == (1022, 25)
    # kept + removed + missing = input; staged + invalid = kept; fact = staged
    assert c["after_dedupe"] + c["duplicates_removed"] + c["missing_key"] == c["input_rows"]
    assert c["staged_rows"] + c["invalid_dates"] == c["after_dedupe"]
    assert c["fact_rows"] == c["staged_rows"]
    fact = read_published(spark, root, "gold_fact_registrations")
    assert fact.count() == c["fact_rows"]
    assert m["writes"]["fact"]["files"] >= 1
    bad = read_published(spark, root, "bad_records")
    assert bad.count() == c["missing_key"] + c["duplicates_removed"] + c["invalid_dates"]
    runs = spark.read.json(f"{root}/metrics")
    assert runs.count() == 1 and runs.first().run_id == m["run_id"]


def test_pipeline_is_deterministic(spark, sf_small):
    def h(root):
        fact = read_published(spark, root, "gold_fact_registrations")
        return fact.select(F.sum(F.xxhash64(*fact.columns).cast("decimal(38,0)")).alias("h")).first().h
    r1, _ = _run(spark, sf_small)
    r2, _ = _run(spark, sf_small)
    assert h(r1) == h(r2)


def test_pipeline_csv_output(spark, sf_small):
    root, m = _run(spark, sf_small, output_format="csv")
    assert m["counts"]["fact_rows"] == 1065
    assert read_published(spark, root, "gold_dim_rta").count() == m["counts"]["dim_rta_rows"]


def test_pipeline_empty_and_all_missing(spark):
    from starwash.schema import RAW_SCHEMA

    m = run_registrations_etl(spark.createDataFrame([], RAW_SCHEMA), output_root=work_path(spark, "t-empty"))
    assert all(v == 0 for v in m["counts"].values())
    rows = [tuple([None] * 14), tuple(["  "] + [None] * 13)]
    m = run_registrations_etl(spark.createDataFrame(rows, RAW_SCHEMA), output_root=work_path(spark, "t-nokey"))
    assert (m["counts"]["input_rows"], m["counts"]["missing_key"], m["counts"]["fact_rows"]) == (2, 2, 0)


def test_pipeline_reference_headers_and_copies(spark):
    """Source header names are conformed; identical copies leave exactly one kept row."""
    from starwash.schema import RAW_SCHEMA

    row = ("TS09AA1234", "1", "Swift VXI", "PETROL", "Red", "LMV", "2018", "5", None, None,
           "Maruti", None, "01/01/2023", "31/12/2023")
    other = ("TS09AA1234", "2", "Swift VXI", "PETROL", "Red", "LMV", "2018", "5", None, None,
             "Maruti", None, "01/01/2020", "31/12/2023")
    raw = spark.createDataFrame([row] * 4 + [other], RAW_SCHEMA).repartition(3)
    root = work_path(spark, "t-copies")
    m = run_registrations_etl(raw, output_root=root)
    c = m["counts"]
    assert (c["input_rows"], c["after_dedupe"], c["duplicates_removed"], c["staged_rows"]) == (5, 1, 4, 1)
    bad = read_published(spark, root, "bad_records")
    assert sorted(r.slno for r in bad.collect()) == ["1", "1", "1", "2"]
    fact = read_published(spark, root, "gold_fact_registrations").first()
    assert (fact.SLNO, fact.REGISTRATION_ISSUE_DATE_ID, fact.REGISTRATION_EXPIRY_DATE_ID) == ("1", 20230101, 20231231)
    # office fallback: a null office takes the issue-date text (reference behaviour)
    import hashlib
    assert fact.RTA_ID == hashlib.sha256(b"01/01/2023").hexdigest()
    assert fact.MANUFACTURER_ID == hashlib.sha256(b"maruti").hexdigest()


def test_pipeline_does_not_depend_on_spread(spark, sf_small):
    """Ranking keys in one bucket or in many changes nothing."""
    def fact_hash(root):
        fact = read_published(spark, root, "gold_fact_registrations")
        return fact.select(F.sum(F.xxhash64(*sorted(fact.columns)).cast("decimal(38,0)")).alias("h")).first().h

    r1, m1 = _run(spark, sf_small)
    root = work_path(spark, "t-spread")
    m2 = run_registrations_etl(dirty(spark, sf_small), output_root=root, conform_input=False,
                               options=CleanOptions(tie_break=DIRTY_TIE_BREAK, spread=1))
    assert m1["counts"] == m2["counts"]
    assert fact_hash(r1) == fact_hash(root)


def test_dimensions_do_not_depend_on_partitioning(spark, sf_small):
    from starwash.operators import stage as S
    from starwash.operators.dims import build_dimensions

    res = S.clean_and_stage(dirty(spark, sf_small), OPTS)
    staged = S.star_columns(res.staged, OPTS)
    a = build_dimensions(staged.repartition(1))
    b = build_dimensions(staged.repartition(7, "colour"))
    for x, y in zip(a, b):
        assert sorted(map(tuple, x.collect()), key=repr) == sorted(map(tuple, y.collect()), key=repr)


def test_append_runs_keep_ids_unique_and_fact_rows_single(spark, sf_small, tmp_path):
    from starwash.plans import DIRTY_TIE_BREAK, dirty, run_registrations_etl
    from starwash.operators.stage import CleanOptions

    work = tmp_path / "work"
    work.mkdir()
    (work / "mine.txt").write_text("keep")
    src, root = dirty(spark, sf_small), str(tmp_path / "star")
    opts = dict(output_root=root, mode="append", options=CleanOptions(tie_break=DIRTY_TIE_BREAK), conform_input=False, work_dir=str(work))
    one = run_registrations_etl(src, **opts)
    two = run_registrations_etl(src, **opts)
    none = run_registrations_etl(src.limit(0), **opts)
    more = run_registrations_etl(src.filter("slno = '1'"), **opts)  # another input, whose vehicles are known
    assert one["counts"]["fact_rows"] > 0 and two["counts"]["fact_rows"] == none["counts"]["fact_rows"] == 0
    assert two["already_loaded"] and more["counts"]["dim_vehicle_rows"] == 0 < more["counts"]["fact_rows"]
    dim = read_published(spark, root, "gold_dim_vehicle")
    assert dim.count() == dim.select("VEHICLE_ID").distinct().count() == one["counts"]["dim_vehicle_rows"]
    assert read_published(spark, root, "gold_fact_registrations").count() == one["counts"]["fact_rows"] + more["counts"]["fact_rows"]
    assert (work / "mine.txt").read_text() == "keep" and [p.name for p in work.iterdir()] == ["mine.txt"]
    assert spark.read.json(f"{root}/metrics").filter("step_json like '%stage%'").count() == 4


def test_a_run_that_dies_leaves_the_old_star(spark, sf_small, monkeypatch):
    from starwash.plans import pipeline
    from starwash.sources.publish import PublishConflict, publish

    root, one = _run(spark, sf_small)
    before = {t: sorted(map(str, read_published(spark, root, t).collect())) for t in current(spark, root)["tables"]}
    half = dirty(spark, sf_small).filter("slno = '2'")
    monkeypatch.setattr(pipeline, "assemble_fact", lambda *a, **k: 1 / 0)  # dimensions are written, the fact is not
    for mode in ("overwrite", "append"):
        try:
            run_registrations_etl(half, output_root=root, options=OPTS, conform_input=False, mode=mode)
            raise AssertionError("the run should have died")
        except ZeroDivisionError:
            pass
        assert {t: sorted(map(str, read_published(spark, root, t).collect())) for t in before} == before
    monkeypatch.undo()
    assert remove_unlisted(spark, root) == 2 and remove_unlisted(spark, root) == 0
    base = current(spark, root)
    two = run_registrations_etl(half, output_root=root, options=OPTS, conform_input=False)
    assert read_published(spark, root, "gold_fact_registrations").count() == two["counts"]["fact_rows"] < one["counts"]["fact_rows"]
    try:
        publish(spark, root, "late", base["tables"], base=base)
        raise AssertionError("made against an old manifest")
    except PublishConflict:
        pass
    assert current(spark, root)["run_id"] == two["run_id"]


def test_row_addresses_change_nothing(spark, sf_small):
    landed = work_path(spark, "t-landed")
    dirty(spark, sf_small).repartition(5).write.parquet(landed)
    roots = []
    for addresses in (False, True):
        roots.append(work_path(spark, "t-addr"))
        m = run_registrations_etl(spark.read.parquet(landed), output_root=roots[-1], conform_input=False,
                                  options=CleanOptions(tie_break=DIRTY_TIE_BREAK, row_addresses=addresses))
        assert m["counts"]["duplicates_removed"] == 4428
    for t in ("gold_fact_registrations", "gold_dim_vehicle", "bad_records"):
        a, b = (read_published(spark, r, t) for r in roots)
        assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


def test_rows_that_cannot_be_parsed_go_to_quarantine(spark, tmp_path):
    from starwash.schema import CANONICAL_RAW_SCHEMA, RAW_COLUMNS
    from starwash.sources import read_csv
    from starwash.sources.readers import ingest_status

    good = ["T1", "1", "Swift VXI", "PETROL", "Red", "LMV", "2018", "5", "", "", "Maruti", "OFF1", "01/01/2023", "31/12/2023"]
    other = ["T2", *good[1:]]
    lines = [",".join(RAW_COLUMNS), ",".join(good), ",".join(other[:9]), ",".join([*other, "more"]), ",".join([*other[:4], '"Red', *other[5:]])]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\n")
    raw = read_csv(spark, str(tmp_path / "a.csv"), CANONICAL_RAW_SCHEMA, bad_rows=True)
    m = run_registrations_etl(raw, output_root=(root := work_path(spark, "t-bad")), options=CleanOptions(), conform_input=False)
    assert m["counts"]["malformed_row"] == 3 and m["counts"]["fact_rows"] == 1 and m["counts"]["missing_key"] == 0
    bad = read_published(spark, root, "bad_records").collect()
    assert {r.reject_reason for r in bad} == {"malformed_row"} and sorted(r["_bad_row"] for r in bad) == sorted(lines[2:])
    status = ingest_status(spark, str(tmp_path), CANONICAL_RAW_SCHEMA).collect()
    assert [(r.status, r.rows, r.bad_rows) for r in status] == [("partial", 4, 3)]
