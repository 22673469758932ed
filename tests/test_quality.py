import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from opslake.operators.quality import (
    Expectation,
    apply_expectations,
    enforce,
    event_log_rows,
    expectation_counts,
)
from opslake.plans.domains import DATASETS
from opslake.sources.test_tables import RAW

CHECKS = (Expectation("qty_positive", "qty > 0", "drop"), Expectation("qty_small", "qty < 100"))


def frame(spark):
    return spark.createDataFrame([(1,), (0,), (None,), (500,)], "qty int")


def test_null_predicates_fail_and_are_dropped(spark):
    assert sorted(r.qty for r in enforce(frame(spark), CHECKS).collect()) == [1, 500]
    counts = {r.expectation: (r.action, r.passed, r.failed) for r in expectation_counts(frame(spark), CHECKS, "d").collect()}
    assert counts == {"qty_positive": ("drop", 2, 2), "qty_small": ("warn", 2, 2)}


def test_counts_ride_along_with_a_batch_job(spark):
    seen = Observation("dq_test")
    kept = apply_expectations(frame(spark), CHECKS, seen)
    assert kept.count() == 2
    assert seen.get == {"rows": 4, "qty_positive": 2, "qty_small": 2}


def test_fail_action_raises(spark):
    strict = [Expectation("qty_known", "qty IS NOT NULL", "fail")]
    with pytest.raises(PySparkException, match="qty_known"):
        enforce(frame(spark), strict).collect()
    assert enforce(frame(spark).filter("qty is not null"), strict).count() == 3
    with pytest.raises(ValueError):
        Expectation("x", "true", "ignore")


def test_event_log_sums_batches(spark):
    log = event_log_rows(
        spark, "r", "d", CHECKS, [{"rows": 3, "qty_positive": 1, "qty_small": 0}, {"rows": 2, "qty_positive": 2}]
    )
    assert [(r.expectation, r.passed, r.failed) for r in log.collect()] == [
        ("qty_positive", 2, 3),
        ("qty_small", 5, 0),
    ]


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_rows_are_kept_or_dropped_and_counted(spark, sf, name):
    spec = DATASETS[name]
    typed = spec.project(RAW[name](spark, sf))
    total = typed.count()
    counts = expectation_counts(typed, spec.expectations, name).collect()
    assert all(r.passed + r.failed == total for r in counts)
    dropped = sum(r.failed for r in counts if r.action == "drop")
    assert spec.silver(RAW[name](spark, sf)).count() == total - dropped


def test_drop_predicates_reach_the_scan(spark, tmp_path):
    spec = DATASETS["purchases"]
    RAW["purchases"](spark, "/root/testdata/sf0.001").write.parquet(str(tmp_path / "p"))
    silver = spec.silver(spark.read.parquet(str(tmp_path / "p"))).agg(F.sum("qty"))
    plan = silver._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(qty,0)" in plan and "ReadSchema: struct<qty:int>" in plan


def test_a_bad_cell_is_null_not_an_error(spark):
    raw = spark.createDataFrame(
        [("1", "x", "2", "3", "10.5", "not a date", "0.1")],
        "purchase_id string, part_id string, supplier_id string, qty string, unit_price_usd string, "
        "purchased_at string, discount_pct string",
    )
    row = DATASETS["purchases"].silver(raw).head()
    assert row.part_id is None and row.purchased_at is None and row.net_unit_price_usd == 10.5 * 0.9
