"""Registered queries that run whole domains and read the resulting catalog tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.checks.queries import raw, register
from opslake.checks.sql import AS_OF, table_sql
from opslake.plans.domains import DATASETS
from opslake.plans.lakehouse import Lakehouse
from opslake.session import scratch_path
from opslake.sources.catalog import create_namespaces
from opslake.sources.rescue import SOURCE_FILE
from opslake.sources.shards import write_shards


def _run(spark: SparkSession, sf: str, *domains: str) -> Lakehouse:
    """Land the domains' datasets and run them in order: streams, tables and gold."""
    root = scratch_path(spark, "lakehouse")
    for spec in DATASETS.values():
        if spec.domain in domains:
            folder = f"{root}/landing/{spec.name}"
            write_shards(raw(spark, sf, spec.name), folder, spec.file_format, spec.shards, spec.key)
    create_namespaces(spark)
    lakehouse = Lakehouse(spark, f"{root}/tables", f"{root}/landing")
    for domain in domains:
        lakehouse.run_domain(domain, AS_OF)
    return lakehouse


@register("table_supplier_performance", table_sql("gold_supplier_performance"))
def table_supplier_performance(spark: SparkSession, sf: str) -> DataFrame:
    """A gold table that its domain's run replaced, read from the catalog."""
    _run(spark, sf, "suppliers")
    return spark.table("suppliers.gold_supplier_performance")


@register("table_pricing_benchmark", table_sql("gold_part_pricing_benchmark"))
def table_pricing_benchmark(spark: SparkSession, sf: str) -> DataFrame:
    """A gold table built from another domain's table."""
    _run(spark, sf, "suppliers", "parts")
    return spark.table("parts.gold_part_pricing_benchmark")


@register("table_alerts_feed", table_sql("reorder_alerts_feed"))
def table_alerts_feed(spark: SparkSession, sf: str) -> DataFrame:
    """The feed that the alert gate published, after a parameterised count."""
    _run(spark, sf, "suppliers", "parts").publish_if_alerts(AS_OF)
    return spark.table("reverse_etl.reorder_alerts_feed")


@register(
    "table_source_files",
    f"select {DATASETS['purchases'].shards} as files, count(*) as delivered from lineitem",
)
def table_source_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every bronze row names the landing file it came from."""
    _run(spark, sf, "suppliers")
    return spark.table("suppliers.bronze_purchases").agg(
        F.count_distinct(SOURCE_FILE).cast("int").alias("files"),
        F.count(SOURCE_FILE).alias("delivered"),
    )
