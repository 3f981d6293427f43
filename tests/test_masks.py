"""Masks decide which values are put to the exact rule."""

from pyspark.sql import functions as F

from quarrystone.operators import masks
from quarrystone.plans import registry
from tests.compare import DATA


def test_plan_looks_masks_up(spark):
    plan = registry.queries()["p6_found"](spark, DATA)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "n_valid" in plan


def test_same_cells_as_the_rules(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/validation.parquet")
    for share in (0.01, 1.1):  # also where no mask is dominant
        profile = masks.MaskProfile(share=share)
        cells = profile.cells(df, "val_id", "load_no").where(~F.col("absent") & ~F.col("valid"))
        want = {(r["row_id"], r["field"]) for r in cells.collect()}
        got = profile.violations(df, "val_id", "load_no").collect()
        assert {(r["row_id"], r["field"]) for r in got} == want and len(got) == len(want) > 0
        assert {r["reason"] for r in got} == ({"rare_mask", "bad_value"} if share < 1 else {"rare_mask"})
