"""Suppliers domain: supplier master data, purchases and spend."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions import business
from opslake.operators.quality import Expectation
from opslake.plans.contracts import Dataset

SUPPLIERS = Dataset(
    name="suppliers",
    domain="suppliers",
    file_format="json",
    shards=3,
    landing_ddl=(
        "supplier_id bigint, name string, region string, tier string, on_time_rate double, "
        "defect_rate_ppm bigint, tax_id string, contact_email string, active bigint"
    ),
    columns={
        "supplier_id": ("supplier_id", "bigint"),
        "supplier_name": ("name", "string"),
        "region": ("region", "string"),
        "tier": ("tier", "string"),
        "on_time_rate": ("on_time_rate", "double"),
        "defect_rate_ppm": ("defect_rate_ppm", "int"),
        "tax_id": ("tax_id", "string"),
        "contact_email": ("contact_email", "string"),
        "active": ("active", "int"),
    },
    expectations=(
        Expectation("on_time_rate_in_range", "on_time_rate BETWEEN 0 AND 1", "drop"),
        Expectation("defect_rate_ppm_nonneg", "defect_rate_ppm >= 0"),
        Expectation("active_flag_known", "active IN (0, 1)"),
    ),
)

PURCHASES = Dataset(
    name="purchases",
    domain="suppliers",
    file_format="csv",
    shards=8,
    landing_ddl=(
        "purchase_id bigint, part_id bigint, supplier_id bigint, qty int, "
        "unit_price_usd double, purchased_at timestamp, discount_pct double"
    ),
    columns={
        "purchase_id": ("purchase_id", "bigint"),
        "part_id": ("part_id", "bigint"),
        "supplier_id": ("supplier_id", "bigint"),
        "qty": ("qty", "int"),
        "unit_price_usd": ("unit_price_usd", "double"),
        "net_unit_price_usd": None,
        "purchased_at": ("purchased_at", "timestamp"),
        "discount_pct": ("discount_pct", "double"),
    },
    expectations=(
        Expectation("qty_positive", "qty > 0", "drop"),
        Expectation("unit_price_positive", "unit_price_usd > 0"),
        Expectation("discount_in_range", "discount_pct BETWEEN 0 AND 1"),
    ),
    derived={
        "net_unit_price_usd": lambda: business.net_price(
            F.col("unit_price_usd"), F.col("discount_pct")
        ),
    },
)


def supplier_spend(purchases: DataFrame) -> DataFrame:
    """Spend per supplier, with the exact count of its distinct purchases.

    Sums are combined before they move, so they cost one row per task and supplier. Only the
    distinct count has to move rows, and it moves two ids per purchase instead of all values;
    it is spread by (supplier, purchase), so a supplier with a large share of all purchases
    does not gather in one task. Purchases are read twice for it, by columns.
    """
    money = purchases.groupBy("supplier_id").agg(
        business.money_sum(F.col("qty") * F.col("net_unit_price_usd")).alias("total_spend_usd"),
        F.avg("net_unit_price_usd").alias("avg_net_price_usd"),
        F.max("purchased_at").alias("last_purchase_at"),
    )
    distinct = purchases.select(F.col("supplier_id").alias("__supplier"), "purchase_id").distinct()
    counted = distinct.groupBy("__supplier").agg(F.count("purchase_id").alias("purchase_count"))
    same = F.col("supplier_id").eqNullSafe(F.col("__supplier"))
    return money.join(counted, same).select(
        # The columns of the result.
        "supplier_id",
        "total_spend_usd",
        "purchase_count",
        "avg_net_price_usd",
        "last_purchase_at",
    )


def gold_supplier_performance(suppliers: DataFrame, purchases: DataFrame) -> DataFrame:
    """One row per supplier; spend columns are NULL for suppliers without purchases."""
    scored = suppliers.select(
        "supplier_id",
        "supplier_name",
        "region",
        "tier",
        F.round(
            business.composite_score(F.col("on_time_rate"), F.col("defect_rate_ppm")), 3
        ).alias("composite_score"),
        F.round("on_time_rate", 3).alias("on_time_rate"),
        "defect_rate_ppm",
    )
    spend = supplier_spend(purchases).withColumns(
        {
            "total_spend_usd": F.round("total_spend_usd", 2),
            "avg_net_price_usd": F.round("avg_net_price_usd", 2),
        }
    )
    return scored.join(spend, "supplier_id", "left")


def gold_spend_by_region(performance: DataFrame) -> DataFrame:
    """Rounded supplier spend rolled up by region and tier."""
    return performance.groupBy("region", "tier").agg(
        F.sum("total_spend_usd").alias("total_spend_usd"),
        F.count_distinct("supplier_id").alias("supplier_count"),
        F.avg("composite_score").alias("avg_composite_score"),
    )
