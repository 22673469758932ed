"""Service operations domain: facilities, work orders, demand and SLA attainment."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.functions import business
from opslake.operators.quality import Expectation
from opslake.plans.contracts import Dataset

CUSTOMERS = Dataset(
    name="customers",
    domain="service_ops",
    file_format="json",
    shards=4,
    landing_ddl=(
        "customer_id bigint, facility_name string, type string, region string, beds bigint, "
        "ssn_last4_contact string, contract_tier string"
    ),
    columns={
        "customer_id": ("customer_id", "bigint"),
        "facility_name": ("facility_name", "string"),
        "facility_type": ("type", "string"),
        "region": ("region", "string"),
        "beds": ("beds", "int"),
        "ssn_last4_contact": ("ssn_last4_contact", "string"),
        "contract_tier": ("contract_tier", "string"),
    },
    expectations=(
        Expectation("beds_positive", "beds > 0"),
        Expectation("contract_tier_known", "contract_tier IN ('Gold', 'Silver', 'Bronze')"),
    ),
)

WORK_ORDERS = Dataset(
    name="work_orders",
    domain="service_ops",
    file_format="csv",
    shards=5,
    landing_ddl=(
        "work_order_id bigint, part_id bigint, customer_id bigint, opened_at timestamp, "
        "closed_at timestamp, status string, priority string, technician_notes string"
    ),
    columns={
        "work_order_id": ("work_order_id", "bigint"),
        "part_id": ("part_id", "bigint"),
        "customer_id": ("customer_id", "bigint"),
        "opened_at": ("opened_at", "timestamp"),
        "closed_at": ("closed_at", "timestamp"),  # empty text is NULL
        "status": ("status", "string"),
        "priority": ("priority", "string"),
        "technician_notes": ("technician_notes", "string"),
    },
    expectations=(
        Expectation("closed_at_after_opened_at", "closed_at IS NULL OR closed_at >= opened_at"),
        Expectation("status_known", "status IN ('closed', 'in_progress', 'open', 'cancelled')"),
        Expectation("priority_known", "priority IN ('P1', 'P2', 'P3', 'P4')"),
    ),
)


def gold_work_order_volume(work_orders: DataFrame) -> DataFrame:
    """Work orders per month opened, priority and status."""
    month = business.month_of(F.col("opened_at")).alias("month")
    return work_orders.groupBy(month, "priority", "status").agg(
        F.count("work_order_id").alias("work_orders")
    )


def gold_part_demand_monthly(work_orders: DataFrame) -> DataFrame:
    """Work orders per part and month; the average covers every closed one, also those
    closed before they were opened."""
    month = business.month_of(F.col("opened_at")).alias("month")
    hours = business.duration_hours(F.col("opened_at"), F.col("closed_at"))
    return work_orders.groupBy("part_id", month).agg(
        F.count("work_order_id").alias("work_orders"),
        F.round(F.avg(hours), 2).alias("avg_duration_hours"),
    )


def gold_sla_performance(work_orders: DataFrame) -> DataFrame:
    """SLA attainment per priority over orders closed at or after they were opened."""
    valid = work_orders.filter(
        (F.col("status") == "closed") & (F.col("closed_at") >= F.col("opened_at"))
    )
    timed = valid.select(
        "priority",
        "work_order_id",
        business.duration_hours(F.col("opened_at"), F.col("closed_at")).alias("hours"),
        business.sla_target_hours(F.col("priority")).alias("target"),
    )
    met = F.count_if(F.col("hours") <= F.col("target"))
    closed = F.count("work_order_id")
    return timed.groupBy("priority").agg(
        closed.alias("closed_orders"),
        met.alias("orders_meeting_sla"),
        F.round(F.avg("hours"), 2).alias("avg_duration_hours"),
        F.round(met / closed, 4).alias("sla_pct"),
    )


def sla_last_quarter(work_orders: DataFrame, as_of: datetime | str | None = None) -> DataFrame:
    """SLA attainment over orders opened in the calendar quarter before the one of ``as_of``."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    this_quarter = F.date_trunc("quarter", now)
    last_quarter = F.date_trunc("quarter", this_quarter - F.expr("INTERVAL 1 MONTH"))
    opened = F.col("opened_at")
    return gold_sla_performance(
        work_orders.filter((opened >= last_quarter) & (opened < this_quarter))
    )
