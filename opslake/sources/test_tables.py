"""The driver's test tables, seen as the six raw landing datasets.

Defects are planted at known keys, so their counts can be checked exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.sources.generate import WAREHOUSES

# The tables' columns. Declared, so that building a query runs no job.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _with_region(spark: SparkSession, sf_dir: str, df: DataFrame, nation_key: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return df.join(nation, F.col(nation_key) == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def raw_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = _with_region(spark, sf_dir, table(spark, sf_dir, "supplier"), "s_nationkey")
    return located.selectExpr(
        "s_suppkey AS supplier_id",
        "s_name AS name",
        "r_name AS region",
        "CASE s_suppkey % 3 WHEN 0 THEN 'Preferred' WHEN 1 THEN 'Approved' ELSE 'Probation' END AS tier",
        "CASE WHEN s_suppkey % 20 = 7 THEN 1.4D ELSE 0.82D + CAST(s_suppkey % 18 AS DOUBLE) / 100 END"
        " AS on_time_rate",
        "CASE WHEN s_suppkey % 10 = 3 THEN -1 ELSE CAST(50 + (s_suppkey * 37) % 3951 AS INT) END"
        " AS defect_rate_ppm",
        "concat(CAST(10 + s_suppkey % 90 AS STRING), '-',"
        " CAST(1000000 + s_suppkey * 7919 % 9000000 AS STRING)) AS tax_id",
        "concat('ops', s_suppkey, '@supplier', s_suppkey, '.example.com') AS contact_email",
        "CASE WHEN s_suppkey % 10 = 5 THEN 2 WHEN s_suppkey % 14 = 0 THEN 0 ELSE 1 END AS active",
    )


def raw_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 10 + l_linenumber AS purchase_id",
        "l_partkey AS part_id",
        "l_suppkey AS supplier_id",
        "CASE WHEN (l_orderkey * 7 + l_linenumber) % 200 = 0 THEN -1 ELSE CAST(l_quantity AS INT) END AS qty",
        "CASE WHEN (l_orderkey * 3 + l_linenumber) % 250 = 1 THEN 0D"
        " ELSE l_extendedprice / l_quantity END AS unit_price_usd",
        "CAST(l_shipdate AS TIMESTAMP) AS purchased_at",
        "CASE WHEN (l_orderkey * 11 + l_linenumber) % 300 = 2 THEN 1.5D ELSE l_discount END AS discount_pct",
    )


def raw_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS part_id",
        "CASE WHEN p_partkey % 33 = 8 THEN NULL ELSE concat('PS-', upper(substring(p_type, 1, 3)), '-',"
        " lpad(CAST(p_partkey AS STRING), 6, '0')) END AS sku",
        "p_name AS name",
        "p_type AS category",
        "p_brand AS manufacturer",
        "CASE WHEN p_partkey % 33 = 0 THEN 0D WHEN p_partkey % 33 = 10 THEN p_retailprice * 64"
        " ELSE p_retailprice END AS list_price_usd",
        "CASE WHEN p_partkey % 33 = 7 THEN 0D ELSE CAST(p_size AS DOUBLE) / 2 END AS weight_kg",
        "CASE WHEN p_partkey % 33 = 5 THEN 1 ELSE 0 END AS hazmat_flag",
        "TIMESTAMP '2019-01-01 00:00:00' AS created_at",
    )


def raw_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five stock rows per part, one per warehouse."""
    per_warehouse = table(spark, sf_dir, "part").select(
        "p_partkey", F.posexplode(F.array(*[F.lit(w) for w in WAREHOUSES])).alias("w", "warehouse")
    )
    return per_warehouse.selectExpr(
        "p_partkey * 5 + w AS inventory_id",
        "p_partkey AS part_id",
        "warehouse",
        "CASE WHEN (p_partkey * 5 + w) % 97 = 13 THEN -1"
        " ELSE CAST((p_partkey * 31 + w * 97) % 501 AS INT) END AS on_hand_qty",
        "CASE WHEN (p_partkey * 5 + w) % 97 = 29 THEN 0"
        " ELSE CAST(5 + (p_partkey * 17 + w * 13) % 96 AS INT) END AS reorder_point",
        "TIMESTAMP '2026-04-01 00:00:00' AS updated_at",
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    located = _with_region(spark, sf_dir, table(spark, sf_dir, "customer"), "c_nationkey")
    return located.selectExpr(
        "c_custkey AS customer_id",
        "c_name AS facility_name",
        "c_mktsegment AS type",
        "r_name AS region",
        "CASE WHEN c_custkey % 50 = 3 THEN 0 ELSE CAST(30 + c_custkey % 871 AS INT) END AS beds",
        "CAST(1000 + (c_custkey * 7919) % 9000 AS STRING) AS ssn_last4_contact",
        "CASE WHEN c_custkey % 50 = 4 THEN 'Unknown' ELSE"
        " CASE c_custkey % 3 WHEN 0 THEN 'Gold' WHEN 1 THEN 'Silver' ELSE 'Bronze' END END AS contract_tier",
    )


def raw_work_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS work_order_id",
        "(o_orderkey * 13) % 200 AS part_id",
        "o_custkey AS customer_id",
        "CAST(o_orderdate AS TIMESTAMP) AS opened_at",
        "CASE WHEN o_orderkey % 50 = 7 THEN 'unknown' WHEN o_orderkey % 50 = 0 THEN 'cancelled' WHEN o_orderstatus = 'F' THEN 'closed'"
        " WHEN o_orderstatus = 'O' THEN 'open' ELSE 'in_progress' END AS status",
        "CASE WHEN o_orderkey % 50 = 9 THEN 'P9'"
        " ELSE CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'P1' WHEN '2' THEN 'P2'"
        " WHEN '3' THEN 'P3' ELSE 'P4' END END AS priority",
    )
    return ordered.selectExpr(
        "work_order_id",
        "part_id",
        "customer_id",
        "opened_at",
        "CASE WHEN status <> 'closed' THEN NULL"
        " WHEN work_order_id % 50 = 1"
        " THEN opened_at - make_dt_interval(0, CAST(1 + work_order_id % 48 AS INT))"
        " ELSE opened_at + make_dt_interval(0, CAST(2 + (work_order_id * 37) % 239 AS INT)) END AS closed_at",
        "status",
        "priority",
        "concat('Replaced unit ', work_order_id) AS technician_notes",
    )


RAW: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "suppliers": raw_suppliers,
    "purchases": raw_purchases,
    "parts": raw_parts,
    "inventory": raw_inventory,
    "customers": raw_customers,
    "work_orders": raw_work_orders,
}
