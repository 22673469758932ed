"""Synthetic raw datasets with known defect rates, generated where their rows are.

Each generator turns a frame of row ids into rows. A value depends on (seed, column, id)
alone, so any partitioning gives the same data and a retried task repeats itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.functions.hashing import choice, randint, weighted

SEED = 42

# Row counts, categories and weights of the demonstration data.
ROWS = {
    "parts": 50_000,
    "suppliers": 200,
    "customers": 1_500,
    "work_orders": 25_000,
    "purchases": 120_000,
    "inventory": 35_000,
}
WAREHOUSES = ("CLE-01", "CHI-02", "DAL-03", "ATL-04", "LAX-05")
CATEGORIES = [
    "Imaging",
    "Patient Monitoring",
    "Infusion",
    "Ventilator",
    "Surgical",
    "Laboratory",
    "Dialysis",
    "Endoscopy",
    "Cardiology",
    "Sterilization",
]
MANUFACTURERS = [
    "GE Healthcare",
    "Philips",
    "Siemens Healthineers",
    "Medtronic",
    "Baxter",
    "Fresenius",
    "Olympus",
    "Stryker",
    "Hill-Rom",
    "B. Braun",
]
REGIONS = ["NE", "SE", "MW", "SW", "W"]
TIERS = ["Preferred", "Approved", "Probation"]
SUPPLIER_KINDS = ["Medical", "Devices", "Parts", "Systems", "Group"]
FACILITY_NAMES = ["St.", "Mercy", "Valley", "Regional", "University"]
FACILITY_KINDS = ["Medical Center", "Health", "Hospital", "Clinic"]
FACILITY_TYPES = ["Academic", "Community", "Specialty", "IDN", "ASC"]
CONTRACT_TIERS = ["Gold", "Silver", "Bronze"]
PRIORITIES = ["P1", "P2", "P3", "P4"]
STATUS_WEIGHTS = {"closed": 70, "in_progress": 18, "open": 10, "cancelled": 2}
ACTIVE_WEIGHTS = {1: 93, 0: 7}
HAZMAT_WEIGHTS = {0: 97, 1: 3}
BAD_PRICE_PERMILLE = 30
BAD_RATE_PERMILLE = 50
BAD_CLOSE_PERMILLE = 20
BAD_QTY_PERMILLE = 5

ID = "id"


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    """Ids 1 to n."""
    return spark.range(1, n + 1)


class _Draws:
    """Random columns of one dataset."""

    def __init__(self, dataset: str, seed: int) -> None:
        self.dataset, self.seed, self.id = dataset, seed, F.col(ID)

    def _args(self, column: str) -> tuple[Column, int, str]:
        return self.id, self.seed, f"{self.dataset}.{column}"

    def int(self, column: str, low: int, high: int) -> Column:
        return randint(*self._args(column), low, high)

    def fraction(self, column: str, low: int, high: int, scale: int) -> Column:
        """Whole multiples of 1/scale between low/scale and high/scale."""
        return self.int(column, low, high) / F.lit(float(scale))

    def pick(self, column: str, values: list) -> Column:
        return choice(*self._args(column), values)

    def weighted(self, column: str, weights: dict) -> Column:
        return weighted(*self._args(column), weights)

    def permille(self, column: str, share: int) -> Column:
        return self.int(column, 0, 999) < share

    def time(self, column: str, start: str, days: int = 0, hours: int = 0) -> Column:
        return F.lit(start).cast("timestamp") + F.make_dt_interval(
            days=self.int(f"{column}.days", 0, days).cast("int"),
            hours=self.int(f"{column}.hours", 0, hours).cast("int"),
        )


def _padded(number: Column, width: int) -> Column:
    """Zeros in front up to ``width``; longer numbers stay whole, unlike with plain lpad."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), "0")


def gen_parts(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """Parts; 3% have a list price of 0."""
    d = _Draws("parts", seed)
    with_picks = ids.select(
        ID,
        d.pick("category", CATEGORIES).alias("category"),
        d.pick("manufacturer", MANUFACTURERS).alias("manufacturer"),
    )
    number = _padded(F.col(ID), 6)
    prefix = F.upper(F.substring("category", 1, 3))
    return with_picks.select(
        F.col(ID).alias("part_id"),
        F.concat_ws("-", F.lit("PS"), prefix, number).alias("sku"),
        F.concat_ws(" ", "manufacturer", "category", F.lit("Part"), F.col(ID)).alias("name"),
        "category",
        "manufacturer",
        F.when(d.permille("bad_price", BAD_PRICE_PERMILLE), F.lit(0.0))
        .otherwise(d.fraction("list_price", 2_500, 1_800_000, 100))
        .alias("list_price_usd"),
        d.fraction("weight", 5, 4_500, 100).alias("weight_kg"),
        d.weighted("hazmat", HAZMAT_WEIGHTS).alias("hazmat_flag"),
        d.time("created", "2019-01-01 00:00:00", days=2400).alias("created_at"),
    )


def gen_suppliers(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """Suppliers; 5% have an on-time rate outside 0 to 1."""
    d = _Draws("suppliers", seed)
    text_id = F.col(ID).cast("string")
    number = _padded(F.col(ID), 3)
    return ids.select(
        F.col(ID).alias("supplier_id"),
        F.concat_ws(" ", F.lit("Supplier"), number, d.pick("kind", SUPPLIER_KINDS)).alias("name"),
        d.pick("region", REGIONS).alias("region"),
        d.pick("tier", TIERS).alias("tier"),
        F.when(d.permille("bad_rate", BAD_RATE_PERMILLE), d.pick("wrong_rate", [-0.1, 1.4]))
        .otherwise(d.fraction("on_time_rate", 820, 995, 1000))
        .alias("on_time_rate"),
        d.int("defect_rate_ppm", 50, 4000).alias("defect_rate_ppm"),
        F.concat_ws(
            "-",
            d.int("tax_prefix", 10, 99).cast("string"),
            d.int("tax_number", 1_000_000, 9_999_999).cast("string"),
        ).alias("tax_id"),
        F.concat(F.lit("ops"), text_id, F.lit("@supplier"), text_id, F.lit(".example.com")).alias(
            "contact_email"
        ),
        d.weighted("active", ACTIVE_WEIGHTS).alias("active"),
    )


def gen_customers(ids: DataFrame, seed: int = SEED) -> DataFrame:
    """Facilities, without defects."""
    d = _Draws("customers", seed)
    return ids.select(
        F.col(ID).alias("customer_id"),
        F.concat_ws(
            " ",
            d.pick("first_name", FACILITY_NAMES),
            d.pick("kind", FACILITY_KINDS),
            F.col(ID).cast("string"),
        ).alias("facility_name"),
        d.pick("type", FACILITY_TYPES).alias("type"),
        d.pick("region", REGIONS).alias("region"),
        d.int("beds", 30, 900).alias("beds"),
        d.int("ssn", 1000, 9999).cast("string").alias("ssn_last4_contact"),
        d.pick("contract_tier", CONTRACT_TIERS).alias("contract_tier"),
    )


def gen_work_orders(
    ids: DataFrame,
    seed: int = SEED,
    n_parts: int = ROWS["parts"],
    n_customers: int = ROWS["customers"],
) -> DataFrame:
    """Work orders; 2% of the closed ones were closed 1 to 48 hours before they were opened."""
    d = _Draws("work_orders", seed)
    drawn = ids.select(
        ID,
        d.time("opened", "2025-10-01 00:00:00", days=200, hours=23).alias("opened_at"),
        d.weighted("status", STATUS_WEIGHTS).alias("status"),
        F.when(d.permille("bad_close", BAD_CLOSE_PERMILLE), -d.int("early_hours", 1, 48))
        .otherwise(d.int("open_hours", 2, 240))
        .cast("int")
        .alias("hours"),
    )
    closed = F.when(
        F.col("status") == "closed", F.col("opened_at") + F.make_dt_interval(hours=F.col("hours"))
    )
    return drawn.select(
        F.col(ID).alias("work_order_id"),
        d.int("part", 1, n_parts).alias("part_id"),
        d.int("customer", 1, n_customers).alias("customer_id"),
        "opened_at",
        closed.alias("closed_at"),
        "status",
        d.pick("priority", PRIORITIES).alias("priority"),
        F.concat(F.lit("Replaced unit "), F.col(ID).cast("string")).alias("technician_notes"),
    )


def gen_purchases(
    ids: DataFrame,
    seed: int = SEED,
    n_parts: int = ROWS["parts"],
    n_suppliers: int = ROWS["suppliers"],
) -> DataFrame:
    """Purchases; 0.5% have a quantity of -1."""
    d = _Draws("purchases", seed)
    return ids.select(
        F.col(ID).alias("purchase_id"),
        d.int("part", 1, n_parts).alias("part_id"),
        d.int("supplier", 1, n_suppliers).alias("supplier_id"),
        F.when(d.permille("bad_qty", BAD_QTY_PERMILLE), -1)
        .otherwise(d.int("qty", 1, 25))
        .cast("int")
        .alias("qty"),
        d.fraction("unit_price", 2_000, 1_500_000, 100).alias("unit_price_usd"),
        d.time("purchased", "2023-01-01 00:00:00", days=1200).alias("purchased_at"),
        d.fraction("discount", 0, 350, 1000).alias("discount_pct"),
    )


def gen_inventory(ids: DataFrame, seed: int = SEED, n_parts: int = ROWS["parts"]) -> DataFrame:
    """Stock rows, without defects; a part may have several."""
    d = _Draws("inventory", seed)
    return ids.select(
        F.col(ID).alias("inventory_id"),
        d.int("part", 1, n_parts).alias("part_id"),
        d.pick("warehouse", list(WAREHOUSES)).alias("warehouse"),
        d.int("on_hand", 0, 500).alias("on_hand_qty"),
        d.int("reorder_point", 5, 100).alias("reorder_point"),
        d.time("updated", "2026-04-01 00:00:00", hours=500).alias("updated_at"),
    )


GENERATORS = {
    "parts": gen_parts,
    "suppliers": gen_suppliers,
    "customers": gen_customers,
    "work_orders": gen_work_orders,
    "purchases": gen_purchases,
    "inventory": gen_inventory,
}
