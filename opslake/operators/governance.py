"""Masked views, column and table tags, and the tag inventory.

A masked view keeps plain values out of a reader's results. It is not a security boundary:
whoever may read the files beneath it sees them.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.functions.masking import MASKS, register_sql_masks
from opslake.sources.catalog import publish_view, table_properties, tag_table

PII_VIEWERS = "pii_viewers"
# Catalog views ask this table whether the current user is one of the group.
VIEWERS = "governance.pii_viewers"
TAGS = "tags"

# Which columns are masked how, and what they and the tables are tagged with.
COLUMN_MASKS = {
    "suppliers.silver_suppliers": {"tax_id": "mask_tax_id", "contact_email": "mask_email"},
    "service_ops.silver_customers": {"ssn_last4_contact": "mask_ssn"},
}
COLUMN_TAGS = {
    "suppliers.silver_suppliers": {
        "tax_id": {"pii": "true", "classification": "restricted"},
        "contact_email": {"pii": "true", "classification": "confidential"},
    },
    "service_ops.silver_customers": {
        "ssn_last4_contact": {"pii": "true", "classification": "restricted"},
        "facility_name": {"pii": "false", "classification": "internal"},
    },
}
STEWARDS = {
    "suppliers.gold_supplier_performance": "supply_chain_team",
    "suppliers.gold_spend_by_region": "supply_chain_team",
    "parts.gold_part_pricing_benchmark": "procurement_team",
    "parts.gold_reorder_needed": "operations_team",
    "service_ops.gold_work_order_volume": "service_team",
    "service_ops.gold_part_demand_monthly": "planning_team",
    "service_ops.gold_sla_performance": "service_team",
}


def is_viewer(viewer_groups: Collection[str]) -> bool:
    """Whether a reader with these groups sees plain values; without groups, no."""
    return PII_VIEWERS in viewer_groups


def masked_view(
    df: DataFrame, masks: Mapping[str, str], viewer_groups: Collection[str] = ()
) -> DataFrame:
    """``df`` with its masked columns replaced for readers outside the viewer group."""
    viewer = is_viewer(viewer_groups)
    unknown = [c for c in masks if c not in df.columns]
    if unknown:
        raise KeyError(f"no such columns to mask: {unknown}")
    return df.select(
        *[
            MASKS[masks[f.name]](F.col(f.name), viewer).alias(f.name, metadata=f.metadata)
            if f.name in masks
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def publish_masked_view(spark: SparkSession, table: str, masks: Mapping[str, str]) -> str:
    """A catalog view ``<table>_masked`` that shows masked columns plain only to readers who are
    listed in ``VIEWERS`` when they ask; returns its name. The masks are SQL functions in the
    table's schema; a new session sees view and functions as they are."""
    unknown = [c for c in masks if c not in spark.table(table).columns]
    if unknown:
        raise KeyError(f"no such columns to mask: {unknown}")
    create_viewers(spark)
    schema = table.split(".")[0]
    register_sql_masks(spark, {mask: schema for mask in masks.values()}, only=set(masks.values()))
    viewer = f"(SELECT count(*) > 0 FROM {VIEWERS} WHERE member = current_user())"
    columns = [
        f"{schema}.{masks[c]}(`{c}`, {viewer}) AS `{c}`" if c in masks else f"`{c}`"
        for c in spark.table(table).columns
    ]
    target = f"{table}_masked"
    publish_view(spark, target, f"SELECT {', '.join(columns)} FROM {table}")
    return target


def create_viewers(spark: SparkSession) -> None:
    """The table of those who may see plain values: a user's name per row. Its files lie in the
    warehouse under a path of their own, so the list outlives a catalog that is kept in memory."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {VIEWERS.split('.')[0]} COMMENT 'Who may see what'")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir')}/_governance/pii_viewers"
    if not spark.catalog.tableExists(VIEWERS):
        schema = StructType().add("member", "string")
        spark.catalog.createTable(VIEWERS, path=folder, source="parquet", schema=schema)


def add_viewer(spark: SparkSession, member: str) -> None:
    create_viewers(spark)
    spark.sql(f"INSERT INTO {VIEWERS} VALUES (:member)", args={"member": member})


def remove_viewer(spark: SparkSession, member: str) -> None:
    create_viewers(spark)
    # The names of a group of people, few enough to rewrite from here.
    left = [(r.member,) for r in spark.table(VIEWERS).collect() if r.member != member]
    spark.createDataFrame(left, "member string").write.insertInto(VIEWERS, overwrite=True)
    spark.catalog.refreshTable(VIEWERS)


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Tags in the columns' metadata, where tables and parquet files keep them."""
    for column, values in tags.items():
        metadata = dict(df.schema[column].metadata)
        metadata[TAGS] = {**metadata.get(TAGS, {}), **values}
        df = df.withMetadata(column, metadata)
    return df


def certify(spark: SparkSession, name: str) -> None:
    """Mark a gold table as certified, with its domain and steward."""
    tag_table(
        spark,
        name,
        {"certified": "true", "domain": name.split(".")[0], "steward": STEWARDS[name]},
    )


def certify_gold(spark: SparkSession) -> None:
    """Mark all gold tables as certified."""
    for name in STEWARDS:
        certify(spark, name)


def tag_inventory(spark: SparkSession, tables: Collection[str]) -> DataFrame:
    """One row per table tag and per column tag: (object, column, tag, value).

    Built from catalog metadata only; its size is the number of tags.
    """
    rows = []
    for name in tables:
        for tag, value in table_properties(spark, name).items():
            rows.append((name, None, tag, value))
        for f in spark.table(name).schema.fields:
            for tag, value in f.metadata.get(TAGS, {}).items():
                rows.append((name, f.name, tag, str(value)))
    return spark.createDataFrame(rows, "object string, column string, tag string, value string")


def tag_coverage(spark: SparkSession, tables: Collection[str]) -> DataFrame:
    """The tag inventory with what each tag stands for: the rows of a tagged table, the values
    that aren't NULL of a tagged column. One aggregate per table, over its tagged columns only."""
    inventory = tag_inventory(spark, tables)
    counted = []
    for name in tables:
        tagged = [f.name for f in spark.table(name).schema.fields if f.metadata.get(TAGS)]
        counts = [F.count(F.lit(1)).alias("0"), *(F.count(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(tagged, 1))]
        entries = ", ".join(f"{c}, `{i}`" for i, c in enumerate(["cast(null as string)", *(f"'{c}'" for c in tagged)]))
        totals = spark.table(name).agg(*counts).select(
            F.lit(name).alias("object"),
            F.expr(f"stack({len(tagged) + 1}, {entries}) as (column, filled)"),
        )
        counted.append(totals)
    filled = reduce(DataFrame.unionByName, counted).alias("f")
    same = (F.col("i.object") == F.col("f.object")) & F.col("i.column").eqNullSafe(F.col("f.column"))
    return inventory.alias("i").join(filled, same).select("i.*", "f.filled")
