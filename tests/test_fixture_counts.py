"""The counts FIXTURES.md documents for the dirty view at sf0.01, through our operators."""

import os

import pytest
from pyspark.sql import functions as F

from starwash.functions import columns as X
from starwash.functions import rules as R
from starwash.operators import stage as S
from starwash.operators.dims import build_dimensions
from starwash.operators.resolve import registration_map, resolve_vehicles
from starwash.plans import DIRTY_TIE_BREAK, dirty

SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_documented_counts_sf001(spark):
    d = dirty(spark, SF)
    opts = S.CleanOptions(tie_break=DIRTY_TIE_BREAK)
    missing, kept, removed = S.dedupe(d, opts)
    assert (d.count(), missing.count(), kept.count(), removed.count()) == (60000, 1232, 14434, 44334)

    res = S.clean_and_stage(d, opts)
    invalid = res.invalid
    assert invalid.count() == 3638
    # of which the office text won the raw string sort
    won = kept.join(invalid.select("reg_no"), "reg_no").filter(F.col("from_date").rlike(R.OFFICE_TEXT_PATTERN))
    assert won.count() == 1972
    # of which another duplicate of the key had a valid date
    latest_valid = S.dedupe(d, S.CleanOptions(tie_break=DIRTY_TIE_BREAK, dedupe_order="latest_valid"))[1]
    rescued = latest_valid.join(invalid.select("reg_no"), "reg_no").filter(X.parse_mixed_date("from_date").isNotNull())
    assert rescued.count() == 3054

    staged = S.star_columns(res.staged, opts)
    assert staged.count() == 10796
    dims = build_dimensions(staged)
    assert dims.vehicle.count() == 1452
    rmap = registration_map(staged, resolve_vehicles(staged, dims.vehicle))
    exact = rmap.filter(~F.col("IS_FUZZY_MATCH")).count()
    null_models = staged.filter(F.col("model_name").isNull()).count()
    fuzzy = rmap.filter(F.col("IS_FUZZY_MATCH")).count()
    assert (exact, null_models, fuzzy) == (10396, 400, 381)
