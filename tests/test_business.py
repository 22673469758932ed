"""Edge cases of the rules, on small frames."""

import pytest
from pyspark.sql import functions as F

from opslake.functions import business, masking
from opslake.plans import feeds, metrics, parts, service_ops, suppliers

AS_OF = "2026-04-20 12:00:00"
PURCHASE = (
    "purchase_id bigint, part_id bigint, supplier_id bigint, qty int, unit_price_usd double, "
    "net_unit_price_usd double, purchased_at timestamp, discount_pct double"
)
PERFORMANCE = (
    "supplier_id bigint, supplier_name string, region string, tier string, composite_score double, "
    "on_time_rate double, defect_rate_ppm int, total_spend_usd double, purchase_count bigint, "
    "avg_net_price_usd double, last_purchase_at timestamp"
)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_supplier_without_purchases_has_null_spend_and_no_feed_row(spark):
    s = spark.sql(
        "select 1L supplier_id, 'a' supplier_name, 'W' region, 'Approved' tier, 0.9D on_time_rate, "
        "500 defect_rate_ppm, '' tax_id, '' contact_email, 1 active"
    )
    perf = suppliers.gold_supplier_performance(s, spark.createDataFrame([], PURCHASE))
    row = one(perf)
    assert row.total_spend_usd is None and row.purchase_count is None
    assert row.composite_score == 0.9
    assert feeds.supplier_tier_feed(perf, AS_OF).count() == 0


def test_spend_counts_distinct_purchases_and_keeps_the_null_supplier(spark):
    rows = [
        (1, 1, 7, 2, 10.0, 9.0, None, 0.1),
        (1, 1, 7, 2, 10.0, 9.0, None, 0.1),
        (2, 1, 7, 1, 10.0, 10.0, None, 0.0),
        (3, 1, None, 1, 4.0, 4.0, None, 0.0),
        (None, 1, 8, 1, 4.0, 4.0, None, 0.0),
    ]
    spend = suppliers.supplier_spend(spark.createDataFrame(rows, PURCHASE))
    got = {r.supplier_id: (r.total_spend_usd, r.purchase_count) for r in spend.collect()}
    assert got == {7: (46.0, 2), None: (4.0, 1), 8: (4.0, 0)}
    paid = one(parts.paid_stats(spark.createDataFrame(rows, PURCHASE)))
    assert paid.purchase_count == 4  # rows with an id, repeated ones included


@pytest.mark.parametrize(
    "score, tier",
    [(0.8495, "Preferred"), (0.8494, "Approved"), (0.70, "Approved"), (0.6994, "Probation")],
)
def test_tier_uses_the_rounded_score(spark, score, tier):
    rounded = F.round(F.lit(score), 3)
    assert one(spark.range(1).select(business.recommended_tier(rounded).alias("t"))).t == tier


def test_reorder_edges_and_dropped_parent(spark):
    inventory = spark.createDataFrame(
        [(1, 1, "W", 20, 20), (2, 1, "W", 10, 20), (3, 1, "W", 9, 20), (4, 1, "W", 21, 20), (5, 99, "W", 0, 30)],
        "inventory_id bigint, part_id bigint, warehouse string, on_hand_qty int, reorder_point int",
    )
    catalogue = spark.sql(
        "select 1L part_id, 's' sku, 'n' part_name, 'c' category, 'm' manufacturer, 2.5D list_price_usd"
    )
    gold = parts.gold_reorder_needed(inventory, catalogue, AS_OF)
    assert sorted(r.shortfall_qty for r in gold.collect()) == [0, 10, 11, 30]
    feed = {r.shortfall_qty: r for r in feeds.reorder_alerts_feed(gold, AS_OF).collect()}
    assert set(feed) == {11, 30}
    assert str(feed[11].est_reorder_value_usd) == "27.50"
    assert feed[30].sku is None and feed[30].est_reorder_value_usd is None
    assert one(feeds.alert_count(gold)).n == 2


def test_savings_may_be_negative_and_need_a_price(spark):
    df = spark.createDataFrame([(10.0, 12.0), (0.0, 1.0), (10.0, None)], "l double, p double")
    got = [r[0] for r in df.select(business.savings_vs_list(F.col("l"), F.col("p"))).collect()]
    assert got == [-0.2, None, None]


ORDERS = (
    "work_order_id bigint, part_id bigint, customer_id bigint, opened_at string, closed_at string, "
    "status string, priority string, technician_notes string"
)


def orders(spark, rows):
    raw = spark.createDataFrame(
        [(i, 1, 1, o, c, s, p, "") for i, (o, c, s, p) in enumerate(rows)], ORDERS
    )
    return service_ops.WORK_ORDERS.silver(raw)


def test_work_order_dates(spark):
    start = "2026-01-10 00:00:00"
    rows = [
        (start, "", "open", "P1"),
        (start, start, "closed", "P1"),
        (start, "2026-01-09 00:00:00", "closed", "P1"),
        (start, "2026-01-12 00:00:00", "closed", "P1"),
        (start, "2026-01-20 00:00:00", "closed", "P9"),
        (start, "2026-01-20 01:00:00", "closed", None),
    ]
    silver = orders(spark, rows)
    assert silver.filter("closed_at is null").count() == 1
    demand = one(service_ops.gold_part_demand_monthly(silver))
    assert demand.work_orders == 6
    assert demand.avg_duration_hours == round((0 - 24 + 48 + 240 + 241) / 5, 2)
    sla = {r.priority: r for r in service_ops.gold_sla_performance(silver).collect()}
    assert (sla["P1"].closed_orders, sla["P1"].orders_meeting_sla, sla["P1"].sla_pct) == (2, 2, 1.0)
    assert sla["P9"].orders_meeting_sla == 1
    assert sla[None].orders_meeting_sla == 0


def test_last_quarter_is_half_open(spark):
    days = ["2025-12-31 23:59:59", "2026-01-01 00:00:00", "2026-03-31 23:59:59", "2026-04-01 00:00:00"]
    silver = orders(spark, [(d, d, "closed", "P1") for d in days])
    assert one(service_ops.sla_last_quarter(silver, AS_OF)).closed_orders == 2


def test_masks(spark):
    df = spark.createDataFrame([("12-3456789",), (None,), ("12",), ("a@b.c",)], "v string")
    v = F.col("v")
    masked = df.select(masking.mask_tax_id(v), masking.mask_email(v), masking.mask_ssn(v)).collect()
    assert [tuple(r) for r in masked] == [
        ("***-*6789", None, "XXXX"),
        (None, None, "XXXX"),
        ("***-*12", None, "XXXX"),
        ("***-*@b.c", "***@b.c", "XXXX"),
    ]
    plain = df.select(masking.mask_ssn(v, True)).collect()
    assert [r[0] for r in plain] == ["12-3456789", None, "12", "a@b.c"]


def test_sql_masks_equal_the_columns(spark):
    spark.sql("create schema if not exists mask_test")
    names = masking.register_sql_masks(spark, {"mask_tax_id": "mask_test"})
    assert names == ["mask_test.mask_tax_id", "mask_email", "mask_ssn"]
    row = spark.sql(
        "select mask_test.mask_tax_id('12-3456789', false) a, mask_email('x@y', false) b, "
        "mask_ssn(null, false) c, mask_ssn('1234', true) d"
    ).head()
    assert tuple(row) == ("***-*6789", "***@y", "XXXX", "1234")


def test_description_keeps_its_spacing(spark):
    df = spark.sql(
        "select 1L part_id, 's' sku, 'Pump' part_name, 'Infusion' category, 'Baxter' manufacturer, "
        "12.5D list_price_usd, hazmat_flag from values (0), (1), (cast(null as int)) t(hazmat_flag)"
    )
    plain = "Pump Category:Infusion Manufactured byBaxter  List price USD12.5"
    hazard = (
        "Pump Category:Infusion Manufactured byBaxter Hazardous material handling required. "
        "List price USD12.5"
    )
    assert [r.description for r in parts.parts_searchable(df).collect()] == [plain, hazard, plain]


def test_empty_batch_sums_to_zero(spark):
    feed = spark.createDataFrame(
        [], "est_reorder_value_usd decimal(18,2), generated_at timestamp"
    )
    row = one(feeds.alert_batch_summary(feed))
    assert row.total_alerts == 0 and str(row.total_value_usd) == "0.00" and row.published_at is None


def test_clean_run_summary(spark):
    perf = spark.createDataFrame(
        [(1, "a", "W", "x", 0.9, 0.9, 5, 1.0, 1, 1.0, None)], PERFORMANCE
    ).withColumn("last_purchase_at", F.lit(AS_OF).cast("timestamp"))
    row = one(feeds.clean_run_summary(spark.range(3), perf))
    assert (row.reorder_rows, row.suppliers_tracked) == (3, 1) and str(row.last_purchase_at) == AS_OF


def test_metric_view_averages_the_ratios(spark):
    gold = spark.createDataFrame(
        [("P1", 10, 10, 5.0, 1.0), ("P2", 90, 45, 7.0, 0.5)],
        "priority string, closed_orders bigint, orders_meeting_sla bigint, "
        "avg_duration_hours double, sla_pct double",
    )
    view = metrics.SLA_PERFORMANCE
    assert one(view.query(gold)).sla_pct == 0.75
    assert view.query(gold, ["priority"], ["closed_orders"], order_by=["-closed_orders"], limit=1).collect() == [
        ("P2", 90)
    ]
    assert one(view.query(gold, measures=["closed_orders"], where="priority = 'P1'")).closed_orders == 10
    with pytest.raises(KeyError):
        view.query(gold, ["month"])
    with pytest.raises(KeyError):
        view.query(gold, measures=["sla"])
    with pytest.raises(ValueError):
        view.query(gold, ["priority"], [])


def test_metric_view_at_full_grain_is_the_source(spark, sf):
    from opslake.checks.queries import performance

    gold = performance(spark, sf)
    full = metrics.SUPPLIER_SPEND.query(
        gold, ["supplier_id", "supplier_name", "region", "tier"], ["total_spend_usd", "avg_on_time_rate"]
    )
    source = gold.select("supplier_id", "supplier_name", "region", "tier", "total_spend_usd", "on_time_rate")
    assert full.exceptAll(source).count() == 0 and source.exceptAll(full).count() == 0


def test_regions_add_up_to_the_suppliers(spark, sf):
    from opslake.checks.queries import performance

    gold = performance(spark, sf)
    by_region = suppliers.gold_spend_by_region(gold).agg(F.sum("total_spend_usd")).head()[0]
    assert by_region == pytest.approx(gold.agg(F.sum("total_spend_usd")).head()[0])


def test_hot_part_is_split_and_stays_whole(spark):
    """A part with a third of all stock rows: the skew join splits it and loses nothing."""
    inventory = spark.range(300_000).selectExpr(
        "id inventory_id", "case when id % 3 = 0 then 7L else id % 5000 end part_id",
        "'W' warehouse", "0 on_hand_qty", "cast(id % 50 as int) reorder_point", "repeat('x', 20) pad",
    )
    catalogue = spark.range(5000).selectExpr(
        "id part_id", "'s' sku", "'n' part_name", "'c' category", "'m' manufacturer", "1D list_price_usd"
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        gold = parts.gold_reorder_needed(inventory, catalogue, AS_OF)
        rows = gold.collect()
        plan = gold._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert len(rows) == 300_000 and all(r.sku == "s" for r in rows)
    assert "skew=true" in plan
