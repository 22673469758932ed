"""The five metric views over the gold tables, and the questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.operators.metric_view import MetricView


METRICS = "business_metrics"


def _view(name: str, source: str, dimensions: list[str], measures: dict[str, str]) -> MetricView:
    return MetricView(
        name=name,
        source=source,
        dimensions={d: d for d in dimensions},
        measures=measures,
        tags={"certified": "true", "metric_view": "true", "domain": source.split(".")[0]},
    )


# Names, dimensions and measures of the views.
# Means are taken over the source rows as they stand: a mean of supplier scores, of monthly
# averages or of SLA shares, never weighted by the counts behind them.
SUPPLIER_SPEND = _view(
    "mv_supplier_spend",
    "suppliers.gold_supplier_performance",
    ["supplier_id", "supplier_name", "region", "tier"],
    {
        "total_spend_usd": "SUM(total_spend_usd)",
        "avg_composite_score": "AVG(composite_score)",
        "avg_on_time_rate": "AVG(on_time_rate)",
        "supplier_count": "COUNT(DISTINCT supplier_id)",
    },
)
PRICING_BENCHMARK = _view(
    "mv_pricing_benchmark",
    "parts.gold_part_pricing_benchmark",
    ["part_id", "sku", "category", "manufacturer"],
    {
        "avg_list_price": "AVG(list_price_usd)",
        "avg_paid_price": "AVG(avg_paid_usd)",
        "avg_savings_pct": "AVG(savings_vs_list_pct)",
        "part_count": "COUNT(DISTINCT part_id)",
    },
)
REORDER_NEEDED = _view(
    "mv_reorder_needed",
    "parts.gold_reorder_needed",
    ["part_id", "sku", "category", "warehouse"],
    {
        "open_reorders": "COUNT(*)",
        "total_shortfall_qty": "SUM(shortfall_qty)",
        "estimated_reorder_value_usd": "SUM(shortfall_qty * list_price_usd)",
    },
)
PART_DEMAND = _view(
    "mv_part_demand",
    "service_ops.gold_part_demand_monthly",
    ["part_id", "month"],
    {"work_orders": "SUM(work_orders)", "avg_duration_hours": "AVG(avg_duration_hours)"},
)
SLA_PERFORMANCE = _view(
    "mv_sla_performance",
    "service_ops.gold_sla_performance",
    ["priority"],
    {
        "closed_orders": "SUM(closed_orders)",
        "orders_meeting_sla": "SUM(orders_meeting_sla)",
        "sla_pct": "AVG(sla_pct)",
        "avg_duration_hours": "AVG(avg_duration_hours)",
    },
)
METRIC_VIEWS = {
    v.name: v
    for v in (SUPPLIER_SPEND, PRICING_BENCHMARK, REORDER_NEEDED, PART_DEMAND, SLA_PERFORMANCE)
}


def top_suppliers_by_spend(source: DataFrame | SparkSession, k: int = 10) -> DataFrame:
    return SUPPLIER_SPEND.query(
        source,
        ["supplier_id", "supplier_name"],
        ["total_spend_usd"],
        order_by=["-total_spend_usd", "supplier_id"],
        limit=k,
    )


def reorder_in_warehouse(source: DataFrame | SparkSession, warehouse: str) -> DataFrame:
    """Parts below their reorder point in one warehouse."""
    if isinstance(source, SparkSession):
        source = source.table(REORDER_NEEDED.source)
    here = source.filter(F.col("warehouse") == warehouse)
    return REORDER_NEEDED.query(here, ["part_id", "sku", "category"])


def parts_below_list(benchmark: DataFrame, share: float = 0.20) -> DataFrame:
    """Parts bought for more than ``share`` below their list price."""
    return benchmark.filter(F.col("savings_vs_list_pct") > share)
