"""Operator edge cases, and exactness checks against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from starwash.functions import columns as X
from starwash.functions import rules as R
from starwash.operators import clean as C
from starwash.operators import stage as S
from starwash.operators.dedupe import keep_latest
from starwash.operators.fact import assemble_fact
from starwash.operators.resolve import best_match, resolve_vehicles, similar_pairs, text_pairs


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("31/02/2023", None),  # invalid calendar date
        ("1995-03-02 00:00:00", None),  # time digits stay glued on
        ("5/5/2022", None),  # single-digit day
        ("04.02.95", dt.date(2095, 2, 4)),  # two-digit years are 2000-2099
        ("1997-04-24", dt.date(1997, 4, 24)),
        ("24-04-1997", dt.date(1997, 4, 24)),
        ("RTA MEDAK", None),
        (None, None),
    ],
)
def test_parse_mixed_date(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(X.parse_mixed_date("s").alias("d")).first().d == expected


def test_model_tokens(spark):
    df = spark.createDataFrame([("Nexon@EV",), ("Truck Trailer",), ("Swift",), (None,), ("a  b\tc",)], "model_desc string")
    rows = C.model_tokens(df).collect()
    got = [(r.model_name, r.variant, r.is_trailer, r.is_electric) for r in rows]
    assert got[0] == ("NEXON", "EV", False, True)
    assert got[1] == ("TRUCK TRAILER", R.TRAILER_VARIANT, True, False)
    assert got[2] == ("SWIFT", "UNKNOWN", False, False)
    assert got[3] == (None, "UNKNOWN", None, None)
    assert got[4][:2] == ("A", "B C")


def test_emission_and_make_year(spark):
    df = spark.createDataFrame([("x BSVI",), ("y BS IV 2018",), ("z BSIIIA 19205",), ("ev car",), (None,)], "model_desc string")
    t = C.backfill_make_year(C.model_tokens(df).withColumn("make_year", F.lit(None).cast("string")))
    parity = [r.emission_standard for r in C.emission_standard(t).collect()]
    fixed = [r.emission_standard for r in C.emission_standard(t, pattern=R.EMISSION_PATTERN_FIXED).collect()]
    assert parity == ["BSV", "BS IV", "BSIIIA", "ELECTRIC", "UNKNOWN"]
    assert fixed == ["BSVI", "BS IV", "BSIIIA", "ELECTRIC", "UNKNOWN"]
    assert [r.make_year for r in t.collect()] == ["UNKNOWN", "2018", "1920", "UNKNOWN", "UNKNOWN"]


def test_dedupe_raw_string_order(spark):
    df = spark.createDataFrame(
        [("K", "31/01/2020", "1"), ("K", "01/12/2024", "2"), ("J", "RTA MEDAK", "1"), ("J", "01/01/2024", "2"),
         ("N", None, "1"), ("N", "01/01/2000", "2")],
        "reg_no string, from_date string, slno string")
    kept, removed = S.dedupe(df, S.CleanOptions(tie_break=("slno",)))[1:]
    got = {r.reg_no: r.slno for r in kept.collect()}
    assert got == {"K": "1", "J": "1", "N": "2"}  # raw string order; nulls last
    assert removed.count() == 3
    latest, _ = S.dedupe(df, S.CleanOptions(tie_break=("slno",), dedupe_order="latest_valid"))[1:]
    assert {r.reg_no: r.slno for r in latest.collect()} == {"K": "2", "J": "2", "N": "2"}


def test_dedupe_identical_copies_across_partitions(spark):
    rows = [("A", "01/01/2020", "x")] * 7 + [("A", "01/01/2019", "y"), ("B", "02/02/2020", "z")] + [("B", "02/02/2020", "z")] * 2
    df = spark.createDataFrame(rows, "reg_no string, from_date string, v string").repartition(4)
    kept, removed = keep_latest(df, "reg_no", [F.col("from_date").desc_nulls_last()])
    assert sorted(tuple(r) for r in kept.collect()) == [("A", "01/01/2020", "x"), ("B", "02/02/2020", "z")]
    rem = sorted(tuple(r) for r in removed.collect())
    assert rem == sorted([("A", "01/01/2020", "x")] * 6 + [("A", "01/01/2019", "y")] + [("B", "02/02/2020", "z")] * 2)
    assert kept.count() + removed.count() == df.count()


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@pytest.mark.parametrize("t", [0, 1, 2, 3])
def test_similar_pairs_equals_brute_force(spark, t):
    rnd = random.Random(7 + t)
    alphabet = "ab c"
    words = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 9))) for _ in range(120)]
    left = [(i, w, w[:1]) for i, w in enumerate(words[:60])]
    right = [(100 + i, w, w[:1]) for i, w in enumerate(words[60:])]
    ldf = spark.createDataFrame(left, "lid int, ltext string, lblock string")
    rdf = spark.createDataFrame(right, "rid int, rtext string, rblock string")
    got = {(r.lid, r.rid, r.d) for r in similar_pairs(ldf, rdf, left_text="ltext", right_text="rtext",
                                                      keys=[("lblock", "rblock")], threshold=t, dist_col="d").collect()}
    want = {(li, ri, _lev(lw, rw)) for li, lw, lb in left for ri, rw, rb in right if lb == rb and _lev(lw, rw) <= t}
    assert got == want


def test_best_match_ties_to_smallest_id(spark):
    pairs = spark.createDataFrame([(1, "b", 1), (1, "a", 1), (1, "c", 0), (2, "z", 2), (2, "y", 2)],
                                  "lid int, rid string, LEV_DIST int")
    got = {r.lid: (r.rid, r.LEV_DIST) for r in best_match(pairs, ["lid"], "rid").collect()}
    assert got == {1: ("c", 0), 2: ("y", 2)}


def _staged_rows(spark, rows):
    df = spark.createDataFrame(rows, "reg_no string, model_name string, variant string, make_year string")
    df = df.withColumns({"maker_name": F.lit("m"), "office_cd": F.lit("o")})
    from starwash.operators.keys import surrogate_keys
    return surrogate_keys(df)


def test_resolution_external_dim(spark):
    staged = _staged_rows(spark, [("r1", "SWIFT", "VDI", "2018"), ("r2", "SWIFF", "VDI", "2018"),
                                  ("r3", None, "VDI", "2018"), ("r4", "ZZZ", "Q", "2018")])
    dim = spark.createDataFrame(
        [("D1", "swift", "vdi", "2018"), ("D2", "SWIFT", "VDI", "2018"), ("D3", "VDI", "X", "2018"), ("D4", "ZZZ", "Q", "2019")],
        "VEHICLE_ID string, MODEL_NAME string, VARIANT string, MAKE_YEAR string")
    vmap = resolve_vehicles(staged, dim)
    got = sorted(((r.model_name, r.VEHICLE_ID_resolved, r.LEV_DIST) for r in vmap.collect()), key=repr)
    # r1 matches two dim rows exactly (fan-out); r2 is 1 edit from 'swift vdi'; r3 (null model)
    # blocks on 'vd' and is within 2 of 'vdi x'; r4 has no row in its year.
    assert got == sorted([("SWIFT", "D1", None), ("SWIFT", "D2", None), ("SWIFF", "D1", 1), (None, "D3", 2)], key=repr)
    fact = assemble_fact(
        staged.withColumns({"from_date_parsed": F.lit(dt.date(2020, 1, 2)), "to_date_parsed": F.lit(None).cast("date"),
                            "vehicle_class": F.lit("c"), "slno": F.lit("1"), "colour": F.lit(None).cast("string"),
                            "fuel_clean": F.lit("PETROL"), "emission_standard": F.lit("UNKNOWN")}), vmap)
    by_reg = {}
    for r in fact.collect():
        by_reg.setdefault(r.TEMP_REGISTRATION_NUMBER, []).append(r)
    assert len(by_reg["r1"]) == 2 and len(by_reg["r4"]) == 1
    assert by_reg["r4"][0].VEHICLE_ID == staged.filter("reg_no = 'r4'").first().VEHICLE_ID
    assert by_reg["r2"][0].IS_FUZZY_MATCH and by_reg["r2"][0].REGISTRATION_ISSUE_DATE_ID == 20200102


@pytest.mark.parametrize(
    "raw, expected",
    [("4.7", 4), (" 5 ", 5), ("n/a", None), ("1e2", None), (".5", 0), ("-3.9", -3), ("+7", 7),
     ("99999999999", None), ("", None), ("-", None), ("5.x", None), (None, None), ("\t12\n", 12)],
)
def test_legacy_int(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(X.legacy_int("s").alias("v")).first().v == expected


@pytest.mark.parametrize("spread", [1, 3, None])
def test_keep_latest_matches_brute_force(spark, spread):
    rnd = random.Random(spread or 0)
    rows = []
    for i in range(400):
        k = "HOT" if i % 3 == 0 else (None if i % 17 == 0 else f"K{rnd.randint(0, 30)}")
        rows.append((k, f"0{rnd.randint(1, 3)}/01/2020", str(rnd.randint(0, 2))))
    rows += [("HOT", "09/09/2099", "x")] * 5  # identical copies of the hot winner
    df = spark.createDataFrame(rows, "reg_no string, from_date string, v string").repartition(5)
    kept, removed = keep_latest(df, "reg_no", [F.col("from_date").desc_nulls_last()], spread=spread)
    # brute force: the first row per key under (from_date desc, then every column asc)
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    want_kept = sorted((min(g, key=lambda r: (_neg(r[1]), r[2])) for g in groups.values()), key=repr)
    got_kept = sorted((tuple(r) for r in kept.collect()), key=repr)
    assert got_kept == want_kept
    want_removed = sorted(rows, key=repr)
    for r in want_kept:
        want_removed.remove(r)
    assert sorted((tuple(r) for r in removed.collect()), key=repr) == want_removed


def test_keep_latest_any_key_type_and_nested_columns(spark):
    rows = [(1, "a", [1, 2], {"x": 1}), (1, "a", [1, 1], {"x": 1}), (1, "a", [1, 1], {"x": 0}),
            (None, "b", None, None), (None, "b", [0], {}), (2, "c", [], None)]
    df = spark.createDataFrame(rows, "k bigint, o string, xs array<int>, m map<string,int>").repartition(3)
    kept, removed = keep_latest(df, "k", [F.col("o").desc_nulls_last()])
    got = {(r.k, tuple(r.xs) if r.xs is not None else None, str(r.m)) for r in kept.collect()}
    assert got == {(1, (1, 1), "{'x': 0}"), (None, None, "None"), (2, (), "None")}
    assert removed.count() == 3
    assert keep_latest(df.limit(0), "k", [F.col("o")]).removed.count() == 0


def _neg(s):
    return tuple(-ord(ch) for ch in s) + (1,)


@pytest.mark.parametrize("seed", [0, 1, 2, 3])
def test_similar_pairs_near_copies_brute_force(spark, seed):
    """Strings with many close neighbours (random edits of each other), t = 0..4."""
    rnd = random.Random(100 + seed)
    alphabet = ["ab", "abc", "ab c", "aab"][seed]
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(30)]
    words = list(base)
    for w in base:
        x = list(w)
        for _ in range(rnd.randint(0, 4)):
            pos, op = rnd.randint(0, len(x)), rnd.random()
            if op < 0.33 and x:
                x.pop(min(pos, len(x) - 1))
            elif op < 0.66:
                x.insert(pos, rnd.choice(alphabet))
            elif x:
                x[min(pos, len(x) - 1)] = rnd.choice(alphabet)
        words.append("".join(x))
    left = [(i, w, 1) for i, w in enumerate(words[::2])]
    right = [(1000 + i, w, 1) for i, w in enumerate(words[1::2])]
    ldf = spark.createDataFrame(left, "lid int, ltext string, lb int")
    rdf = spark.createDataFrame(right, "rid int, rtext string, rb int")
    for t in range(5):
        got = {(r.lid, r.rid, r.d) for r in similar_pairs(ldf, rdf, left_text="ltext", right_text="rtext",
                                                          keys=[("lb", "rb")], threshold=t, dist_col="d").collect()}
        want = {(li, ri, _lev(lw, rw)) for li, lw, _ in left for ri, rw, _ in right if _lev(lw, rw) <= t}
        assert got == want, t


def test_prefix_block_equals_brute_force_without_all_pairs(spark):
    """Two-character blocks and names of 4 to 12 characters: right pairs, from few candidates."""
    rnd = random.Random(3)
    names = ["ab" + "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 10))) for _ in range(300)]
    names += [n[:-1] + "x" for n in names[:60]]
    left = spark.createDataFrame([(i, n, n[:2]) for i, n in enumerate(names[::2])], "lid int, ltext string, lblock string")
    right = spark.createDataFrame([(i, n, n[:2]) for i, n in enumerate(names[1::2])], "rid int, rtext string, rblock string")
    how = dict(left_text="ltext", right_text="rtext", keys=[("lblock", "rblock")], threshold=3, prefix=("lblock", "rblock"))
    got = {(r.lid, r.rid, r.d) for r in similar_pairs(left, right, dist_col="d", **how).collect()}
    want = {(i, j, _lev(a, b)) for i, a in enumerate(names[::2]) for j, b in enumerate(names[1::2]) if _lev(a, b) <= 3}
    assert got == want
    a, b = (df.select(F.col(f"{s}block").alias("k"), F.expr(f"substr({s}text, 3)").alias(f"_{n}")) for df, s, n in ((left, "l", "a"), (right, "r", "b")))
    compared = text_pairs(a, b, ["k"], 3, verified=False).filter("length(_a) >= 6 and length(_b) >= 6").distinct().count()
    assert compared < a.filter("length(_a) >= 6").count() * b.filter("length(_b) >= 6").count() / 4


@pytest.mark.parametrize("t", [1, 2, 3, 4])
def test_names_of_one_model_line_are_not_all_compared(spark, t):
    """Names that share most of their letters: few are compared, and the join emits pairs within the distance only."""
    rnd = random.Random(t)
    names = ["swift dzire " + "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8)) for _ in range(260)]
    names += ["swift dzire" + n[11:-1] for n in names[:20]] + ["swift dzire" + n[12:] for n in names[20:40]]
    left = spark.createDataFrame([("sw", n) for n in names], "k string, _a string")
    right = left.withColumnRenamed("_a", "_b")
    pairs = text_pairs(left, right, ["k"], t)
    got = {(r["_a"], r["_b"]) for r in pairs.collect()}
    probe = {n for n in names if any(m != n and (n, m) in got for m in names)}
    assert {(n, n) for n in names} <= got and {n for n in names[:40]} <= probe
    assert got == {(a, b) for a in names for b in names if abs(len(a) - len(b)) <= t and _lev(a[11:], b[11:]) <= t}
    assert pairs.count() <= 20 * len(got)
    compared = text_pairs(left, right, ["k"], t, verified=False).distinct().count()
    assert t == 4 or compared < len(names) ** 2 / 10  # eight letters of their own give four rare segments, not five


def test_row_addresses_equal_windows_for_all_kinds_of_order(spark, tmp_path):
    """First rows by addresses and by windows, for descending texts, numbers and times with nulls, copies and ties."""
    from starwash.operators.dedupe import By, mark_first, mark_first_at

    rnd = random.Random(6)
    pick = lambda *v: rnd.choice([None, *v])
    rows = [(pick("a", "b", "HOT"), pick("x", "xy", "", "é", "x~"), pick(1, -5, -2**63), pick(0.5, float("nan"), -1.0),
             pick(dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 1, 0, 0, 0, 5)), pick(dt.date(1960, 1, 1), dt.date(2020, 1, 1)), pick("u", "v"))
            for _ in range(400)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows * 2, "k string, s string, n long, f double, t timestamp_ntz, d date, x string").repartition(7).write.parquet(path)
    scan = spark.read.parquet(path)
    for columns in (["s", "x"], ["n"], ["f", "s"], ["t", "n"], ["d"]):
        for desc in (True, False):
            by = [By(F.col(c), desc) for c in columns]
            marked = lambda df: sorted(map(str, df.select(*scan.columns, "_first").collect()))
            want = marked(mark_first(scan, "k", [b.order for b in by], apart=F.col("x") == "v"))
            assert marked(mark_first_at(scan, "k", by, apart=F.col("x") == "v")) == want, (columns, desc)
    assert marked(mark_first_at(scan, "k", by, broadcast_bytes=5000)) == marked(mark_first(scan, "k", [b.order for b in by]))


def test_one_window_where_no_key_is_hot(spark):
    """A spread of 1 moves every row once and marks as many windows do; rows apart are never first."""
    from starwash.operators.dedupe import FIRST, mark_first, spread_for

    rows = [(None if k % 10 == 0 else f"k{k % 40}", k % 7, k % 3) for k in range(600)]
    df = spark.createDataFrame(rows, "reg_no string, a int, b int").repartition(5)
    apart = F.col("reg_no").isNull()
    one, many = (mark_first(df, "reg_no", [F.col("a").desc()], n, apart) for n in (1, None))
    count = lambda x: sorted(map(tuple, x.groupBy("reg_no", "a", "b", FIRST).count().collect()), key=repr)
    assert count(one) == count(many)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1
    assert spread_for(df, "reg_no", apart) == 1 and spread_for(df, "reg_no", apart, most=5) is None
    assert spread_for(df.limit(0), "reg_no") == 1


def test_resolution_broadcasts_no_dimension(spark):
    """Joins with a dimension, and of its exploded segments, do not pass through the driver, however small its files."""
    from starwash.operators.resolve import resolve_vehicles

    cols = "VEHICLE_ID string, model_name string, variant string, MAKE_YEAR_KEY string"
    staged = spark.createDataFrame([("v1", "SWIFT", "VXI", "2018"), ("v2", "SWIFT", "VXO", "2018")], cols)
    dim = spark.createDataFrame([("d1", "SWIFT", "VXI", "2018")], "VEHICLE_ID string, MODEL_NAME string, VARIANT string, MAKE_YEAR string")
    out = resolve_vehicles(staged, dim)
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.VEHICLE_ID, r.VEHICLE_ID_resolved, r.LEV_DIST) for r in out.collect()}
    assert got == {("v1", "d1", None), ("v2", "d1", 1)}


def test_written_tags_equal_the_lazy_ones(spark, tmp_path):
    """Rows marked and written first, then derived, are those of ``tagged_rows``; rejects are written as they came."""
    rows = [("T1", "1", "ace LXI BSIV 2018", "2024-01-02", "x"), ("T1", "2", None, "2023-01-02", None), (None, "3", "m", "2023-01-02", "y"),
            ("  ", "4", "m", None, ""), ("T2", "5", "@EV  car", "31/02/2023", "z"), ("T3", "6", "unk now", "RTA MEDAK", None),
            ("T4", "7", "tipper#9", "05.06.24", "q"), ("T4", "7", "tipper#9", "05.06.24", "q")]
    raw = spark.createDataFrame([(k, n, m, "DIESEL", None, None, "", None, o, None, d, None) for k, n, m, d, o in rows],
                                "reg_no string, slno string, model_desc string, fuel string, colour string, vehicle_class string, make_year string, "
                                "seat_capacity string, maker_name string, office_cd string, from_date string, to_date_raw string")
    opts = S.CleanOptions(tie_break=("slno",), spread=1)
    lazy, written = S.tagged_rows(raw, opts), S.write_tagged(raw, f"{tmp_path}/t", opts)
    names = sorted(lazy.columns)
    assert names == sorted(written.columns)
    key = lambda df: sorted(map(repr, df.select(*names).collect()))
    assert key(lazy) == key(written)
    # the rows of the first write are raw: no rejected row is parsed
    assert spark.read.parquet(f"{tmp_path}/t/marked").columns == [*raw.columns, S.REJECT_REASON]
