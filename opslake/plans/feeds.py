"""Feeds for operational systems, the alert gate and the batch summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions import business
from opslake.operators.metric_view import sort_column
from opslake.plans.parts import generated_at


def _urgent(reorder: DataFrame) -> DataFrame:
    return reorder.filter(F.col("shortfall_qty") > business.URGENT_SHORTFALL)


def alert_count(reorder: DataFrame) -> DataFrame:
    """One row: how many reorder rows are urgent."""
    return _urgent(reorder).agg(F.count(F.lit(1)).alias("n"))


def reorder_alerts_feed(reorder: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Urgent reorder rows with their estimated value."""
    value = business.reorder_value(F.col("shortfall_qty"), F.col("list_price_usd"))
    return _urgent(reorder).select(
        # The columns of the feed.
        "part_id",
        "sku",
        "part_name",
        "category",
        "warehouse",
        "on_hand_qty",
        "reorder_point",
        "shortfall_qty",
        "list_price_usd",
        value.alias("est_reorder_value_usd"),
        generated_at(as_of).alias("generated_at"),
    )


def supplier_tier_feed(performance: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """Recommended tier of every supplier with spend."""
    return performance.filter(F.col("total_spend_usd").isNotNull()).select(
        # The columns of the feed.
        "supplier_id",
        "supplier_name",
        "region",
        "tier",
        "composite_score",
        "on_time_rate",
        "total_spend_usd",
        business.recommended_tier(F.col("composite_score")).alias("recommended_tier"),
        generated_at(as_of).alias("generated_at"),
    )


def top_alerts(feed: DataFrame, k: int = 10) -> DataFrame:
    """The k alerts with the highest value; part and warehouse break ties."""
    order = ("-est_reorder_value_usd", "part_id", "warehouse")
    return feed.orderBy(*[sort_column(c) for c in order]).limit(k)


def alert_batch_summary(feed: DataFrame) -> DataFrame:
    """Alerts, their total value (0 for an empty batch) and the batch's stamp, in one pass."""
    total = F.sum("est_reorder_value_usd")
    return feed.agg(
        F.count(F.lit(1)).alias("total_alerts"),
        F.coalesce(total, F.lit(0).cast("decimal(28,2)")).alias("total_value_usd"),
        F.max("generated_at").alias("published_at"),
    )


def clean_run_summary(reorder: DataFrame, performance: DataFrame) -> DataFrame:
    """Reorder rows, suppliers tracked and the last purchase, from one aggregate over both."""
    tracked = performance.select(
        F.lit(0).alias("is_reorder"), F.lit(1).alias("is_supplier"), "last_purchase_at"
    )
    waiting = reorder.select(
        F.lit(1).alias("is_reorder"),
        F.lit(0).alias("is_supplier"),
        F.lit(None).cast("timestamp").alias("last_purchase_at"),
    )
    return tracked.unionByName(waiting).agg(
        F.count_if(F.col("is_reorder") == 1).alias("reorder_rows"),
        F.count_if(F.col("is_supplier") == 1).alias("suppliers_tracked"),
        F.max("last_purchase_at").alias("last_purchase_at"),
    )
