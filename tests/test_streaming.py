"""Inbox stream: one pipeline run per file, failures isolated."""

from pyspark.sql import functions as F

from starwash.plans import dirty
from starwash.operators.stage import CleanOptions
from starwash.schema import CANONICAL_RAW_SCHEMA
from starwash.session import work_path
from starwash.streaming import inbox_status, start_inbox

from named_files import write_named


def test_inbox_runs_each_file(spark, sf_small):
    inbox = work_path(spark, "t-inbox-stream")
    out = work_path(spark, "t-inbox-out")
    d = dirty(spark, sf_small).withColumns(
        {"second_vehicle": F.lit(None).cast("string"), "category": F.lit(None).cast("string")}
    ).select(*CANONICAL_RAW_SCHEMA.fieldNames())  # CSV columns are read by position
    write_named(d.filter(F.col("slno") == "1").coalesce(1), "csv", f"{inbox}/_a", inbox, "a.csv")
    write_named(d.filter(F.col("slno") == "2").coalesce(1), "csv", f"{inbox}/_b", inbox, "b.csv")
    q = start_inbox(spark, inbox, out, fmt="csv", schema=CANONICAL_RAW_SCHEMA,
                    options=CleanOptions(tie_break=("slno",)), conform_input=False,
                    read_options={"nullValue": "\\N"})
    q.awaitTermination(300)
    st = {r.file_name: (r.status, r.rows) for r in inbox_status(spark, out).collect()}
    assert set(st) == {"a.csv", "b.csv"}
    assert all(s == "ok" for s, _ in st.values())
    assert st["a.csv"][1] == d.filter(F.col("slno") == "1").count()
    # a second start finds nothing to do
    again = start_inbox(spark, inbox, out, fmt="csv", schema=CANONICAL_RAW_SCHEMA, conform_input=False)
    again.awaitTermination(300)
    assert inbox_status(spark, out).count() == 2


def test_inbox_isolates_a_bad_file(spark, sf_small):
    inbox = work_path(spark, "t-inbox-bad")
    out = work_path(spark, "t-inbox-bad-out")
    good = dirty(spark, sf_small).withColumns(
        {"second_vehicle": F.lit(None).cast("string"), "category": F.lit(None).cast("string")}
    ).select(*CANONICAL_RAW_SCHEMA.fieldNames()).filter(F.col("slno") == "3").coalesce(1)
    # header does not match the declared schema: the run for this file fails
    bad = spark.createDataFrame([("x", "y")], "wrong string, header string").coalesce(1)
    write_named(bad, "csv", f"{inbox}/_a", inbox, "a_bad.csv")
    write_named(good, "csv", f"{inbox}/_b", inbox, "b_good.csv")
    q = start_inbox(spark, inbox, out, fmt="csv", schema=CANONICAL_RAW_SCHEMA,
                    options=CleanOptions(tie_break=("slno",)), conform_input=False,
                    read_options={"nullValue": "\\N"})
    q.awaitTermination(300)
    st = sorted((r.status, r.file_name) for r in inbox_status(spark, out).collect())
    assert [s for s, _ in st] == ["failed", "ok"] and st[1][1] == "b_good.csv"
