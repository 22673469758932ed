"""Parts domain: catalogue, inventory, paid prices and reorder needs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.functions import business
from opslake.operators.quality import Expectation
from opslake.plans.contracts import Dataset

PARTS = Dataset(
    name="parts",
    domain="parts",
    file_format="csv",
    shards=5,
    landing_ddl=(
        "part_id bigint, sku string, name string, category string, manufacturer string, "
        "list_price_usd double, weight_kg double, hazmat_flag int, created_at timestamp"
    ),
    columns={
        "part_id": ("part_id", "bigint"),
        "sku": ("sku", "string"),
        "part_name": ("name", "string"),
        "category": ("category", "string"),
        "manufacturer": ("manufacturer", "string"),
        "list_price_usd": ("list_price_usd", "double"),
        "weight_kg": ("weight_kg", "double"),
        "hazmat_flag": ("hazmat_flag", "int"),
        "created_at": ("created_at", "timestamp"),
    },
    expectations=(
        Expectation("list_price_positive", "list_price_usd > 0", "drop"),
        Expectation("weight_positive", "weight_kg > 0"),
        Expectation("sku_present", "length(sku) > 0"),
    ),
)

INVENTORY = Dataset(
    name="inventory",
    domain="parts",
    file_format="json",
    shards=3,
    landing_ddl=(
        "inventory_id bigint, part_id bigint, warehouse string, on_hand_qty bigint, "
        "reorder_point bigint, updated_at string"
    ),
    columns={
        "inventory_id": ("inventory_id", "bigint"),
        "part_id": ("part_id", "bigint"),
        "warehouse": ("warehouse", "string"),
        "on_hand_qty": ("on_hand_qty", "int"),
        "reorder_point": ("reorder_point", "int"),
        "updated_at": ("updated_at", "timestamp"),
    },
    expectations=(
        Expectation("on_hand_nonneg", "on_hand_qty >= 0"),
        Expectation("reorder_point_positive", "reorder_point > 0"),
    ),
)


def generated_at(as_of: datetime | str | None) -> Column:
    """Generation stamp: the given time, or the time the query starts."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp")


def paid_stats(purchases: DataFrame) -> DataFrame:
    """What was paid per part. Counts rows, not distinct purchases.

    The mean is that of the prices in units of 1e-10, as whole numbers, so it does not depend on
    the order in which rows are added. Billions of units and the rest are added apart, in 64 bits
    each, and put together once per part.
    """
    price = F.col("net_unit_price_usd")
    units = F.rint(price * F.lit(1e10)).cast("bigint")
    found = purchases.select("part_id", price, "purchase_id", "purchased_at", units.alias("units"))
    sums = found.groupBy("part_id").agg(
        F.expr("sum(units div 1000000000)").alias("billions"),
        F.expr("sum(units % 1000000000)").alias("rest"),
        F.count(price).alias("priced"),
        F.min(price).alias("best_paid_usd"),
        F.count("purchase_id").alias("purchase_count"),
        F.max("purchased_at").alias("last_purchase_at"),
    )
    total = """cast(cast(cast(billions as decimal(20,0)) * 1000000000BD + rest as decimal(28,0))
      * 0.0000000001BD as double)"""
    return sums.select(
        "part_id",
        F.try_divide(F.expr(total), F.col("priced").cast("double")).alias("avg_paid_usd"),
        "best_paid_usd",
        "purchase_count",
        "last_purchase_at",
    )


def gold_part_pricing_benchmark(parts: DataFrame, purchases: DataFrame) -> DataFrame:
    """List against paid price per part; paid columns are NULL for parts never bought.

    The join reuses the aggregate's partitioning by part, so only the catalogue moves.
    """
    priced = parts.select(
        "part_id", "sku", "part_name", "category", "manufacturer", "list_price_usd"
    ).join(paid_stats(purchases), "part_id", "left")
    savings = business.savings_vs_list(F.col("list_price_usd"), F.col("avg_paid_usd"))
    return priced.select(
        # The columns of the result.
        "part_id",
        "sku",
        "part_name",
        "category",
        "manufacturer",
        F.round("list_price_usd", 2).alias("list_price_usd"),
        business.cents(F.col("avg_paid_usd")).alias("avg_paid_usd"),
        business.cents(F.col("best_paid_usd")).alias("best_paid_usd"),
        "purchase_count",
        F.round(savings, 4).alias("savings_vs_list_pct"),
        "last_purchase_at",
    )


def gold_reorder_needed(
    inventory: DataFrame, parts: DataFrame, as_of: datetime | str | None = None
) -> DataFrame:
    """Stock at or below its reorder point, per part and warehouse.

    Stock of a part that silver dropped stays, with NULL part columns. The filter runs
    before the join, and a part with very many stock rows is split by the adaptive
    skew join, which may split the left side of a left join.
    """
    low = inventory.filter(F.col("on_hand_qty") <= F.col("reorder_point")).select(
        "part_id",
        "warehouse",
        "on_hand_qty",
        "reorder_point",
        (F.col("reorder_point") - F.col("on_hand_qty")).alias("shortfall_qty"),
    )
    catalogue = parts.select(
        "part_id",
        "sku",
        "part_name",
        "category",
        "manufacturer",
        F.round("list_price_usd", 2).alias("list_price_usd"),
    )
    return low.join(catalogue, "part_id", "left").select(
        # The columns of the result.
        "part_id",
        "sku",
        "part_name",
        "category",
        "manufacturer",
        "warehouse",
        "on_hand_qty",
        "reorder_point",
        "list_price_usd",
        "shortfall_qty",
        generated_at(as_of).alias("generated_at"),
    )


# What a search result shows of a part.
SHOWN = ["sku", "part_name", "category", "manufacturer", "list_price_usd"]


def parts_searchable(parts: DataFrame) -> DataFrame:
    """Catalogue columns plus the description that similarity search embeds."""
    description = business.part_description(
        *[F.col(c) for c in ("part_name", "category", "manufacturer", "hazmat_flag", "list_price_usd")]
    )
    return parts.select(
        # The columns of the result.
        "part_id",
        "sku",
        "part_name",
        "category",
        "manufacturer",
        "list_price_usd",
        "hazmat_flag",
        description.alias("description"),
    )
