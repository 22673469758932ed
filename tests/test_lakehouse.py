"""Generated data, landed, streamed and served end to end."""

import pytest
from pyspark.sql import functions as F

from opslake.plans.domains import DATASETS
from opslake.plans.lakehouse import Lakehouse
from opslake.sources import generate
from opslake.sources.shards import write_shards

AS_OF = "2026-04-20 12:00:00"
SIZES = {"parts": 900, "suppliers": 120, "customers": 80, "work_orders": 1500, "purchases": 4000, "inventory": 1200}


def generated(spark, name, first=1, last=None, partitions=None):
    last = SIZES[name] if last is None else last
    ids = spark.range(first, last + 1, 1, partitions)
    sizes = {
        "work_orders": {"n_parts": SIZES["parts"], "n_customers": SIZES["customers"]},
        "purchases": {"n_parts": SIZES["parts"], "n_suppliers": SIZES["suppliers"]},
        "inventory": {"n_parts": SIZES["parts"]},
    }
    return generate.GENERATORS[name](ids, **sizes.get(name, {}))


def land(spark, root, name, df, folder="first"):
    spec = DATASETS[name]
    write_shards(df, f"{root}/{name}/{folder}", spec.file_format, spec.shards, spec.key)


@pytest.mark.parametrize("name", sorted(generate.GENERATORS))
def test_generators_do_not_depend_on_partitions(spark, name):
    one, many = generated(spark, name, partitions=1), generated(spark, name, partitions=7)
    assert one.exceptAll(many).count() == 0 and many.count() == SIZES[name]
    assert one.schema.names == DATASETS[name].landing_schema.names


def test_defect_rates(spark):
    n = 40_000
    ids = generate.row_ids(spark, n)

    def share(df, bad, of="true"):
        return df.filter(of).agg(F.avg(F.expr(bad).cast("int"))).head()[0]

    assert share(generate.gen_parts(ids), "list_price_usd = 0") == pytest.approx(0.03, abs=0.004)
    assert share(generate.gen_suppliers(ids), "on_time_rate not between 0 and 1") == pytest.approx(0.05, abs=0.005)
    assert share(generate.gen_purchases(ids), "qty <= 0") == pytest.approx(0.005, abs=0.002)
    orders = generate.gen_work_orders(ids)
    assert share(orders, "closed_at < opened_at", "status = 'closed'") == pytest.approx(0.02, abs=0.004)
    assert share(orders, "status = 'closed'") == pytest.approx(0.70, abs=0.02)
    assert share(generate.gen_suppliers(ids), "active = 1") == pytest.approx(0.93, abs=0.01)
    assert share(generate.gen_parts(ids), "hazmat_flag = 1") == pytest.approx(0.03, abs=0.005)


def test_ids_beyond_the_hash_modulus_differ(spark):
    far = spark.range(2**40, 2**40 + 2000)
    near = spark.range(2**40 % 2147483647, 2**40 % 2147483647 + 2000)
    a, b = (generate.gen_customers(d).drop("customer_id", "facility_name") for d in (far, near))
    assert a.distinct().count() > 1900
    assert a.exceptAll(b).count() > 1900


@pytest.fixture(scope="module")
def lakehouse(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    for name in DATASETS:
        land(spark, root / "landing", name, generated(spark, name))
    house = Lakehouse(spark, str(root / "tables"), str(root / "landing"))
    house.summary = house.run(AS_OF).head()
    return house


def counts(spark):
    tables = [f"{d.domain}.{layer}_{d.name}" for d in DATASETS.values() for layer in ("bronze", "silver")]
    return {t: spark.table(t).count() for t in tables}


def test_first_run(spark, lakehouse):
    got = counts(spark)
    assert all(got[f"{d.domain}.bronze_{d.name}"] == SIZES[d.name] for d in DATASETS.values())
    alerts = spark.table("parts.gold_reorder_needed").filter("shortfall_qty > 10").count()
    assert lakehouse.summary.total_alerts == alerts > 0
    assert str(lakehouse.summary.published_at) == AS_OF
    assert spark.table("reverse_etl.reorder_alerts_feed").count() == alerts
    assert spark.newSession().table("suppliers.silver_suppliers_masked").filter("tax_id not like '***-*%'").count() == 0


def test_metric_views_are_in_the_catalog(spark, lakehouse):
    from opslake.operators.governance import tag_inventory
    from opslake.plans.metrics import METRIC_VIEWS

    for view in METRIC_VIEWS.values():
        published = spark.table(f"business_metrics.{view.name}")
        asked = view.query(spark, list(view.dimensions))
        assert published.columns == asked.columns and published.count() == asked.count() > 0
    tags = {(r.tag, r.value) for r in tag_inventory(spark, ["business_metrics.mv_part_demand"]).collect()}
    assert {("metric_view", "true"), ("domain", "service_ops"), ("measure.work_orders", "SUM(work_orders)")} <= tags
    certified = tag_inventory(spark, ["suppliers.gold_spend_by_region", "suppliers.silver_suppliers"])
    assert certified.filter("tag = 'steward' and value = 'supply_chain_team'").count() == 1
    assert certified.filter("column = 'tax_id' and tag = 'pii' and value = 'true'").count() == 1


def test_event_log_counts_the_defects_exactly(spark, lakehouse):
    log = {r.expectation: r.failed for r in lakehouse.event_log().collect()}
    bad = {
        "on_time_rate_in_range": ("suppliers", "on_time_rate not between 0 and 1"),
        "list_price_positive": ("parts", "list_price_usd <= 0"),
        "qty_positive": ("purchases", "qty <= 0"),
        "closed_at_after_opened_at": ("work_orders", "closed_at < opened_at"),
    }
    for name, (dataset, predicate) in bad.items():
        assert log[name] == generated(spark, dataset).filter(predicate).count()
    assert sum(log.values()) == sum(log[name] for name in bad)


def test_gold_from_streams_equals_gold_from_batches(spark, lakehouse):
    from opslake.plans import suppliers

    silver = {n: DATASETS[n].silver(generated(spark, n)) for n in ("suppliers", "purchases")}
    want = suppliers.gold_supplier_performance(silver["suppliers"], silver["purchases"])
    got = spark.table("suppliers.gold_supplier_performance")
    assert got.count() == want.count() and got.select(*want.columns).exceptAll(want).count() == 0


def test_search_over_the_synced_index(spark, lakehouse):
    index = spark.table("parts.parts_searchable_index")
    assert index.count() == spark.table("parts.silver_parts").count()
    asked = spark.createDataFrame(
        [(1, "dialysis parts from Baxter"), (2, "hazardous ventilator")], "query_id int, query_text string"
    )
    hits = lakehouse.search_parts(asked, k=3).collect()
    assert len(hits) == 6 and lakehouse.search_parts(asked).columns[-1] == "score"
    assert {(r.category, r.manufacturer) for r in hits if r.query_id == 1} == {("Dialysis", "Baxter")}
    assert {r.category for r in hits if r.query_id == 2} == {"Ventilator"}


def test_later_runs(spark, lakehouse):
    before, events = counts(spark), lakehouse.event_log().count()
    lakehouse.run(AS_OF)
    assert counts(spark) == before and lakehouse.event_log().count() == events

    land(spark, lakehouse.landing, "purchases", generated(spark, "purchases", 4001, 4500), "second")
    lakehouse.run_domain("suppliers", AS_OF)
    after = counts(spark)
    assert after["suppliers.bronze_purchases"] == 4500
    assert after["suppliers.bronze_suppliers"] == before["suppliers.bronze_suppliers"]

    lakehouse.refresh_dataset("purchases", full=True)
    assert counts(spark) == after


def test_feeds_stay_without_alerts(spark, lakehouse):
    kept = spark.table("reverse_etl.reorder_alerts_feed").count()
    real = spark.table("parts.gold_reorder_needed")
    calm = real.filter("shortfall_qty <= 10")
    from opslake.sources.catalog import materialize

    materialize(calm, "parts.gold_reorder_needed", f"{lakehouse.root}/gold")
    assert lakehouse.publish_if_alerts(AS_OF) == 0
    assert spark.table("reverse_etl.reorder_alerts_feed").count() == kept


def test_drifting_and_growing_datasets(spark, tmp_path):
    landing = tmp_path / "landing"
    parts = generated(spark, "parts")
    land(spark, landing, "parts", parts.filter("part_id <= 400"), "a")
    land(spark, landing, "parts", parts.filter("part_id > 400").select(*reversed(parts.columns)).withColumn("origin", F.lit("DE")), "b")
    inventory = generated(spark, "inventory")
    land(spark, landing, "inventory", inventory.filter("inventory_id <= 600"), "a")
    house = Lakehouse(spark, str(tmp_path / "tables"), str(landing))
    got = house.refresh_dataset("parts", register=False)
    want = DATASETS["parts"].silver(parts)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    assert house.registry.load("parts").schema.names[-1] == "origin"

    house.refresh_dataset("inventory", register=False)
    land(spark, landing, "inventory", inventory.filter("inventory_id > 600").withColumn("bin", F.lit("A1")), "b")
    assert house.refresh_dataset("inventory", register=False).count() == SIZES["inventory"]
    known = house.registry.load("inventory")
    assert known.schema.names[-1] == "bin" and known.schema["on_hand_qty"].dataType.simpleString() == "bigint"
