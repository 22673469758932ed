"""The registered queries: each takes (spark, sf_dir) and reads the test tables whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.checks import sql
from opslake.checks.sql import AS_OF, expectation_sql, settled, table_sql, with_ctes
from opslake.operators.quality import expectation_counts
from opslake.plans import feeds, metrics, parts, service_ops, suppliers
from opslake.plans.domains import DATASETS
from opslake.plans.metrics import METRICS
from opslake.session import scratch_path
from opslake.sources.catalog import create_namespaces
from opslake.sources.test_tables import RAW

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def raw(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    return RAW[dataset](spark, sf)


def silver(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    return DATASETS[dataset].silver(raw(spark, sf, dataset))


def settle_doubles(df: DataFrame) -> DataFrame:
    """Money sums to four places, other doubles to six; see ``sql.settled``."""
    return df.select(
        *[
            F.round(F.col(c) + 10.0 ** -(p + 3), p).alias(c) if t == "double" else F.col(c)
            for c, t in df.dtypes
            for p in [4 if c.startswith(("total_", "estimated_")) else 6]
        ]
    )


# --- gold inputs shared by the serving queries -----------------------------------------


def performance(spark: SparkSession, sf: str) -> DataFrame:
    return suppliers.gold_supplier_performance(
        silver(spark, sf, "suppliers"), silver(spark, sf, "purchases")
    )


def benchmark(spark: SparkSession, sf: str) -> DataFrame:
    return parts.gold_part_pricing_benchmark(
        silver(spark, sf, "parts"), silver(spark, sf, "purchases")
    )


def reorder(spark: SparkSession, sf: str) -> DataFrame:
    return parts.gold_reorder_needed(
        silver(spark, sf, "inventory"), silver(spark, sf, "parts"), AS_OF
    )


def demand(spark: SparkSession, sf: str) -> DataFrame:
    return service_ops.gold_part_demand_monthly(silver(spark, sf, "work_orders"))


def sla(spark: SparkSession, sf: str) -> DataFrame:
    return service_ops.gold_sla_performance(silver(spark, sf, "work_orders"))


def alerts(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.reorder_alerts_feed(reorder(spark, sf), AS_OF)


# --- silver tables and expectations ----------------------------------------------------

for _name in DATASETS:
    register(f"silver_{_name}", table_sql(f"silver_{_name}"))(
        lambda spark, sf, d=_name: silver(spark, sf, d)
    )


def _counts(spark: SparkSession, sf: str, dataset: str, action: str | None = None) -> DataFrame:
    spec = DATASETS[dataset]
    wanted = [e for e in spec.expectations if action in (None, e.action)]
    return expectation_counts(spec.project(raw(spark, sf, dataset)), wanted, dataset)


for _name, _spec in DATASETS.items():
    for _action in ("drop", "warn"):
        if any(e.action == _action for e in _spec.expectations):
            register(f"dq_{_action}_{_name}", expectation_sql([_name], _action))(
                lambda spark, sf, d=_name, a=_action: _counts(spark, sf, d, a)
            )


@register("dq_event_log", expectation_sql(list(DATASETS)))
def dq_event_log(spark: SparkSession, sf: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [_counts(spark, sf, d) for d in DATASETS])


# --- aggregates and gold tables --------------------------------------------------------


@register(
    "supplier_spend",
    with_ctes(
        "supplier_spend",
        f"select supplier_id, {settled('total_spend_usd', 4)} as total_spend_usd, purchase_count, "
        f"{settled('avg_net_price_usd', 6)} as avg_net_price_usd, last_purchase_at from supplier_spend",
    ),
)
def supplier_spend(spark: SparkSession, sf: str) -> DataFrame:
    return settle_doubles(suppliers.supplier_spend(silver(spark, sf, "purchases")))


@register(
    "paid_stats",
    with_ctes(
        "paid_stats",
        f"select part_id, {settled('avg_paid_usd', 6)} as avg_paid_usd, "
        f"{settled('best_paid_usd', 6)} as best_paid_usd, purchase_count, last_purchase_at from paid_stats",
    ),
)
def paid_stats(spark: SparkSession, sf: str) -> DataFrame:
    return settle_doubles(parts.paid_stats(silver(spark, sf, "purchases")))


register("gold_supplier_performance", table_sql("gold_supplier_performance"))(performance)
register("gold_part_pricing_benchmark", table_sql("gold_part_pricing_benchmark"))(benchmark)
register("gold_reorder_needed", table_sql("gold_reorder_needed"))(reorder)
register("gold_part_demand_monthly", table_sql("gold_part_demand_monthly"))(demand)
register("gold_sla_performance", table_sql("gold_sla_performance"))(sla)


@register("gold_work_order_volume", table_sql("gold_work_order_volume"))
def work_order_volume(spark: SparkSession, sf: str) -> DataFrame:
    return service_ops.gold_work_order_volume(silver(spark, sf, "work_orders"))


@register(
    "gold_spend_by_region",
    with_ctes(
        "gold_supplier_performance",
        f"select region, tier, {settled('sum(total_spend_usd)', 4)} as total_spend_usd, "
        f"count(distinct supplier_id) as supplier_count, {settled('avg(composite_score)', 6)} as avg_composite_score "
        "from gold_supplier_performance group by region, tier",
    ),
)
def spend_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return settle_doubles(suppliers.gold_spend_by_region(performance(spark, sf)))


# --- metric views ----------------------------------------------------------------------

_MV_SOURCES = {
    "mv_supplier_spend": performance,
    "mv_pricing_benchmark": benchmark,
    "mv_reorder_needed": reorder,
    "mv_part_demand": demand,
    "mv_sla_performance": sla,
}
_MV_SQL = {
    "mv_supplier_spend": (
        f"{settled('sum(total_spend_usd)', 4)} as total_spend_usd, {settled('avg(composite_score)', 6)} as avg_composite_score, "
        f"{settled('avg(on_time_rate)', 6)} as avg_on_time_rate, count(distinct supplier_id) as supplier_count"
    ),
    "mv_pricing_benchmark": (
        f"{settled('avg(list_price_usd)', 6)} as avg_list_price, {settled('avg(avg_paid_usd)', 6)} as avg_paid_price, "
        f"{settled('avg(savings_vs_list_pct)', 6)} as avg_savings_pct, count(distinct part_id) as part_count"
    ),
    "mv_reorder_needed": (
        f"count(*) as open_reorders, cast(sum(shortfall_qty) as bigint) as total_shortfall_qty, "
        f"{settled('sum(shortfall_qty * list_price_usd)', 4)} as estimated_reorder_value_usd"
    ),
    "mv_part_demand": (
        f"cast(sum(work_orders) as bigint) as work_orders, {settled('avg(avg_duration_hours)', 6)} as avg_duration_hours"
    ),
    "mv_sla_performance": (
        f"cast(sum(closed_orders) as bigint) as closed_orders, "
        f"cast(sum(orders_meeting_sla) as bigint) as orders_meeting_sla, {settled('avg(sla_pct)', 6)} as sla_pct, "
        f"{settled('avg(avg_duration_hours)', 6)} as avg_duration_hours"
    ),
}
_MV_CUTS = {
    "mv_supplier_spend_by_region": ("mv_supplier_spend", ["region"]),
    "mv_supplier_spend_by_tier": ("mv_supplier_spend", ["tier"]),
    "mv_supplier_spend_total": ("mv_supplier_spend", []),
    "mv_pricing_benchmark_by_category": ("mv_pricing_benchmark", ["category"]),
    "mv_pricing_benchmark_by_manufacturer": ("mv_pricing_benchmark", ["manufacturer"]),
    "mv_reorder_needed_by_warehouse": ("mv_reorder_needed", ["warehouse"]),
    "mv_reorder_needed_by_category": ("mv_reorder_needed", ["category"]),
    "mv_part_demand_by_month": ("mv_part_demand", ["month"]),
    "mv_part_demand_by_part": ("mv_part_demand", ["part_id"]),
    "mv_sla_performance_by_priority": ("mv_sla_performance", ["priority"]),
    "mv_sla_performance_total": ("mv_sla_performance", []),
}


def _metric_cut(spark: SparkSession, sf: str, view: str, dims: list[str]) -> DataFrame:
    """A cut rolled up in SQL from the catalog's table of states."""
    create_namespaces(spark)
    metric = metrics.METRIC_VIEWS[view]
    metric.publish(spark, METRICS, scratch_path(spark, "states"), _MV_SOURCES[view](spark, sf))
    return settle_doubles(metric.rollup(spark, METRICS, dims))


for _name, (_view, _dims) in _MV_CUTS.items():
    _source = metrics.METRIC_VIEWS[_view].source.split(".")[1]
    _by = ", ".join(_dims)
    register(
        _name,
        with_ctes(
            _source,
            f"select {_by + ', ' if _by else ''}{_MV_SQL[_view]} from {_source}"
            + (f" group by {_by}" if _by else ""),
        ),
    )(lambda spark, sf, v=_view, d=_dims: _metric_cut(spark, sf, v, d))


# --- questions asked of the gold tables ------------------------------------------------


@register(
    "top_suppliers_by_spend",
    with_ctes(
        "gold_supplier_performance",
        f"select supplier_id, supplier_name, {settled('sum(total_spend_usd)', 4)} as total_spend_usd "
        "from gold_supplier_performance group by 1, 2 "
        "order by total_spend_usd desc nulls last, supplier_id limit 10",
    ),
)
def top_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return settle_doubles(metrics.top_suppliers_by_spend(performance(spark, sf)))


@register(
    "reorder_in_warehouse",
    with_ctes(
        "gold_reorder_needed",
        f"select part_id, sku, category, {_MV_SQL['mv_reorder_needed']} from gold_reorder_needed "
        "where warehouse = 'CHI-02' group by 1, 2, 3",
    ),
)
def reorder_in_warehouse(spark: SparkSession, sf: str) -> DataFrame:
    return settle_doubles(metrics.reorder_in_warehouse(reorder(spark, sf), "CHI-02"))


@register(
    "parts_below_list",
    with_ctes(
        "gold_part_pricing_benchmark",
        "select * from gold_part_pricing_benchmark where savings_vs_list_pct > 0.20",
    ),
)
def parts_below_list(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.parts_below_list(benchmark(spark, sf))


@register(
    "sla_last_quarter",
    with_ctes(
        "silver_work_orders",
        sql.sla_over(
            f"(select * from silver_work_orders where opened_at >= date_trunc('quarter', timestamp '{AS_OF}') "
            f"- interval 3 month and opened_at < date_trunc('quarter', timestamp '{AS_OF}')) q"
        ),
    ),
)
def sla_last_quarter(spark: SparkSession, sf: str) -> DataFrame:
    return service_ops.sla_last_quarter(silver(spark, sf, "work_orders"), AS_OF)


# --- feeds and summaries ---------------------------------------------------------------

register("reorder_alerts_feed", table_sql("reorder_alerts_feed"))(alerts)


@register(
    "supplier_tier_feed",
    with_ctes(
        "gold_supplier_performance",
        f"""select supplier_id, supplier_name, region, tier, composite_score, on_time_rate, total_spend_usd,
 case when composite_score >= 0.85 then 'Preferred' when composite_score >= 0.70 then 'Approved'
  else 'Probation' end as recommended_tier, timestamp '{AS_OF}' as generated_at
from gold_supplier_performance where total_spend_usd is not null""",
    ),
)
def tier_feed(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.supplier_tier_feed(performance(spark, sf), AS_OF)


@register(
    "alert_count",
    with_ctes(
        "gold_reorder_needed",
        "select count(*) as n from gold_reorder_needed where shortfall_qty > 10",
    ),
)
def alert_count(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.alert_count(reorder(spark, sf))


@register(
    "top_alerts",
    with_ctes(
        "reorder_alerts_feed",
        "select * from reorder_alerts_feed order by est_reorder_value_usd desc nulls last, part_id, warehouse "
        "limit 10",
    ),
)
def top_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.top_alerts(alerts(spark, sf))


@register(
    "alert_batch_summary",
    with_ctes(
        "reorder_alerts_feed",
        "select count(*) as total_alerts, cast(coalesce(sum(est_reorder_value_usd), 0) as decimal(28,2)) "
        "as total_value_usd, max(generated_at) as published_at from reorder_alerts_feed",
    ),
)
def alert_batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.alert_batch_summary(alerts(spark, sf))


@register(
    "clean_run_summary",
    with_ctes(
        "gold_reorder_needed gold_supplier_performance",
        "select (select count(*) from gold_reorder_needed) as reorder_rows, count(*) as suppliers_tracked, "
        "max(last_purchase_at) as last_purchase_at from gold_supplier_performance",
    ),
)
def clean_run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.clean_run_summary(reorder(spark, sf), performance(spark, sf))


register("parts_searchable", table_sql("parts_searchable"))(
    lambda spark, sf: parts.parts_searchable(silver(spark, sf, "parts"))
)
