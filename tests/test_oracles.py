"""Every registered query against its DuckDB oracle at sf0.001."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

from oracle_check import TABLES, digest  # noqa: E402

import __spark_entry__ as E  # noqa: E402

NAMES = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf_small, name):
    sdf = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows) == digest(rel.columns, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = {r.metric: r.value for r in df.collect()}
    assert rows["input_rows"] == 6000 and rows["fact_rows"] == rows["staged_rows"]


def test_rows_only_queries(spark, sf_small):
    for name in set(E.queries()) - set(E.oracle_sql()):
        assert E.queries()[name](spark, sf_small).count() >= 1
