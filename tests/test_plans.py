"""Plan properties that carry the design at scale (checked on the optimized
physical plans, not on timings)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from starwash.plans.catalog import QUERIES
from starwash.operators import stage as S
from starwash.operators.dedupe import FIRST, By, first_addresses, mark_first, mark_first_at, winners
from starwash.plans import DIRTY_TIE_BREAK, dirty, fixtures
from starwash.plans.fixtures import DIRTY_RAW, table

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")

def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def written_plans(monkeypatch):
    """Plans of all frames that are written while the test runs."""
    plans = []
    write = DataFrame.write

    def noted(df):
        plans.append(_plan(df))
        return write.fget(df)

    monkeypatch.setattr(DataFrame, "write", property(noted))
    return plans


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_python_in_plans(spark, sf_small, written_plans, name):
    """The query's plan and those of all tables that it writes on its way."""
    plans = [_plan(QUERIES[name](spark, sf_small)), *written_plans]
    assert not [tok for plan in plans for tok in FORBIDDEN if tok in plan], name


def test_stage_plan_shape(spark, sf_small):
    src = table(spark, sf_small, "lineitem").select(
        *[F.col("l_returnflag").alias(c) if c in ("reg_no", "from_date") else F.lit("x").alias(c) for c in DIRTY_RAW[:12]])
    plan = _plan(S.tagged_rows(src))
    # one scan, two windows, no join and nothing broadcast, whatever the keys
    assert plan.count("Scan parquet") == 1 and plan.count("hashpartitioning") == 2
    assert "Join" not in plan and "BroadcastExchange" not in plan
    # the kept rows alone: top-1 per key is limited on the map side, before the shuffle
    kept = _plan(S.dedupe(dirty(spark, sf_small), S.CleanOptions(tie_break=DIRTY_TIE_BREAK))[1])
    assert kept.count("WindowGroupLimit") >= 2


def test_windows_shuffle_no_hash_and_no_copy_of_the_key(spark, sf_small):
    """What is shuffled for the windows is the rows themselves, and a slot where all of them are marked."""
    raw = dirty(spark, sf_small)
    for rows, extra in ((winners(raw, "reg_no", [F.col("from_date").desc_nulls_last()]), 0),
                        (mark_first(raw, "reg_no", [F.col("from_date").desc_nulls_last()], 1, F.col("fuel").isNull()), 1)):
        tree = rows._jdf.queryExecution().optimizedPlan()
        while not tree.nodeName().startswith("Window") or tree.children().head().nodeName().startswith("Window"):
            tree = tree.children().head()
        assert tree.children().head().output().size() == len(raw.columns) + extra, tree.toString()


def test_marks_with_rows_apart_that_have_keys(spark):
    """Rows apart are never first, and take no other row's place, whether they have a key or not."""
    rows = [("a", 1, False), ("a", 3, True), ("a", 2, None), ("a", 3, True), (None, 1, False), (None, 2, True), ("b", 5, True), ("", 1, False)]
    df = spark.createDataFrame(rows, "k string, v int, off boolean")
    for spread in (1, 3):
        got = mark_first(df, "k", [F.col("v").desc()], spread, F.col("off")).collect()
        assert sorted((tuple(r)[:2] for r in got if r[FIRST]), key=str) == [("", 1), ("a", 2), (None, 1)]
        assert len(got) == len(rows)


def test_view_tasks_are_sized_by_rows(spark, sf_small, monkeypatch):
    """From some size on a task of the view derives a bounded number of rows, and the view stays the same."""
    lines = table(spark, sf_small, "lineitem").count()
    before = dirty(spark, sf_small).collect()
    tasks = spark.sparkContext.defaultParallelism + 3
    monkeypatch.setattr(fixtures, "ROWS_IN_TASK", -(-lines // tasks))
    rows = dirty(spark, sf_small)
    plan = _plan(rows)
    assert plan.count("hashpartitioning") == 2 and plan.count("REPARTITION_BY_NUM") == 1
    assert rows.rdd.getNumPartitions() == -(-lines // fixtures.ROWS_IN_TASK) > spark.sparkContext.defaultParallelism
    assert sorted(rows.collect(), key=str) == sorted(before, key=str)


def test_row_addresses_shuffle_keys_and_ties_only(spark, tmp_path, written_plans):
    """One shuffle, of a row for each key, finds the first rows; of other rows only those that tie with a first one come near another."""
    rows = spark.range(4000).selectExpr("if(id % 8 < 3, 'HOT', if(id % 97 = 0, null, 'k' || id % 700)) k", "id % 7 o", "id % 4 x", "if(id % 2 = 0, 0.0D, -0.0D) z", "id")
    rows.drop("id").union(rows.filter("k = 'HOT'").selectExpr("k", "6L", "3L", "z")).repartition(5).write.parquet(str(tmp_path / "ties"))
    rows.repartition(5).write.parquet(str(tmp_path / "none"))
    ties, none = (spark.read.parquet(str(tmp_path / name)) for name in ("ties", "none"))
    written_plans.clear()
    only_keys = _plan(first_addresses(none, "k", [By(F.col("o"), desc=True), By(F.col("id"))]))
    assert written_plans[0].count("hashpartitioning") == 1
    assert "Exchange" not in only_keys and "Join" not in only_keys  # no tie: nothing is compared
    tied = first_addresses(ties, "k", [By(F.col("o"), desc=True)])
    plan = _plan(tied)
    scanned = plan.index("ReadSchema: struct<k:string")  # of the rows, joined with the bitmap before they are sorted or shuffled
    above = [line.split("- ", 1)[1] for line in plan[:scanned].splitlines() if "- " in line]
    nodes = [line.split(" ")[0].split("(")[0] for line in above]
    assert nodes[-1:] == ["FileScan"] and {"Exchange", "Sort"}.isdisjoint(nodes[len(nodes) - nodes[::-1].index("BroadcastHashJoin"):])
    for key, by in (("k", [By(F.col("o"), desc=True)]), ("k", [By(F.col("z"))]), ("z", [By(F.col("o"))])):
        want = mark_first(ties, key, [b.order for b in by])
        count = lambda df: sorted(map(tuple, df.groupBy("k", "o", "x", "z", FIRST).count().collect()), key=repr)
        assert count(mark_first_at(ties, key, by)) == count(want), (key, by)


def test_narrow_scans_are_pruned(spark, sf_small):
    plan = QUERIES["date_parts"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_filters_reach_the_scan(spark, sf_small):
    df = table(spark, sf_small, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE").select("c_custkey")
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(c_mktsegment), Not(EqualTo(c_mktsegment,AUTOMOBILE))]" in plan
