"""Registered queries that go through landing files, streams and table writes.

Each writes the test tables to a new folder in the shared scratch area, in the landing
formats, and returns what comes out at the other end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.checks.generate_sql import generated
from opslake.checks.queries import raw, register
from opslake.checks.sql import expectation_sql, table_sql, with_ctes
from opslake.operators.quality import apply_expectations
from opslake.plans.domains import DATASETS
from opslake.plans.lakehouse import Lakehouse
from opslake.session import discard, scratch_path
from opslake.sources import generate
from opslake.sources.rescue import SOURCE_FILE, bronze_schema, rescue_json_lines
from opslake.sources.schemas import infer_schema
from opslake.sources.shards import write_shards
from opslake.sources.test_tables import table
from opslake.streaming.tables import (
    ingest_stream,
    read_table,
    stream_table,
    write_stream,
)


def _land(spark: SparkSession, sf: str, dataset: str, root: str) -> str:
    """The raw dataset as landing shards; returns their folder."""
    spec = DATASETS[dataset]
    path = f"{root}/landing/{dataset}"
    write_shards(raw(spark, sf, dataset), path, spec.file_format, spec.shards, spec.key)
    return path


def _ingest(spark: SparkSession, landing: str, root: str, dataset: str, schema: StructType) -> DataFrame:
    stream = ingest_stream(spark, landing, DATASETS[dataset].file_format, schema)
    write_stream(stream, f"{root}/bronze", f"{root}/bronze_checkpoint")
    return read_table(spark, f"{root}/bronze", bronze_schema(schema)).drop(SOURCE_FILE)


def _ingest_landed(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    root = scratch_path(spark, f"ingest-{dataset}")
    landing = _land(spark, sf, dataset, root)
    return _ingest(spark, landing, root, dataset, DATASETS[dataset].landing_schema)


_NO_RESCUE = "cast(null as varchar) as _rescued"


@register(
    "ingest_csv_stream", with_ctes("raw_purchases", f"select *, {_NO_RESCUE} from raw_purchases")
)
def ingest_csv_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest_landed(spark, sf, "purchases")


_INVENTORY_LANDED = f"""select inventory_id, part_id, warehouse, on_hand_qty::bigint as on_hand_qty,
 reorder_point::bigint as reorder_point, strftime(updated_at, '%Y-%m-%d %H:%M:%S') as updated_at, {_NO_RESCUE}
from raw_inventory"""


@register("ingest_json_stream", with_ctes("raw_inventory", _INVENTORY_LANDED))
def ingest_json_stream(spark: SparkSession, sf: str) -> DataFrame:
    return _ingest_landed(spark, sf, "inventory")


def _stream_silver(spark: SparkSession, sf: str, dataset: str) -> tuple[DataFrame, list[dict]]:
    """Landing files to silver, both steps as streams, with the observed counts."""
    spec = DATASETS[dataset]
    root = scratch_path(spark, f"silver-{dataset}")
    _ingest(spark, _land(spark, sf, dataset, root), root, dataset, spec.landing_schema)
    bronze = stream_table(spark, f"{root}/bronze", bronze_schema(spec.landing_schema))
    checked = apply_expectations(spec.project(bronze), spec.expectations, f"dq_{dataset}")
    counts = write_stream(checked, f"{root}/silver", f"{root}/silver_checkpoint")
    return read_table(spark, f"{root}/silver", checked.schema), counts


for _name in ("purchases", "inventory", "work_orders", "suppliers", "parts", "customers"):
    register(f"stream_silver_{_name}", table_sql(f"silver_{_name}"))(
        lambda spark, sf, d=_name: _stream_silver(spark, sf, d)[0]
    )


@register("stream_event_log", expectation_sql(["work_orders"]))
def stream_event_log(spark: SparkSession, sf: str) -> DataFrame:
    """The event log of a dataset after a run."""
    root = scratch_path(spark, "event-log")
    _land(spark, sf, "work_orders", root)
    lakehouse = Lakehouse(spark, f"{root}/tables", f"{root}/landing")
    lakehouse.refresh_dataset("work_orders", register=False)
    return lakehouse.event_log().drop("run_id")


@register(
    "ingest_header_reorder",
    with_ctes("raw_purchases", f"select *, {_NO_RESCUE} from raw_purchases"),
)
def ingest_header_reorder(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries of one dataset, the second with its columns in another order."""
    root = scratch_path(spark, "reorder")
    spec = DATASETS["purchases"]
    rows = raw(spark, sf, "purchases")
    large = F.col("qty") > 25
    landing = f"{root}/landing/purchases"
    write_shards(rows.filter(~large), f"{landing}/first", "csv", 4, spec.key)
    reordered = rows.select(*reversed(rows.columns))
    write_shards(reordered.filter(large), f"{landing}/second", "csv", 4, spec.key)
    house = Lakehouse(spark, f"{root}/tables", f"{root}/landing")
    house.refresh_dataset("purchases", register=False)
    return house.bronze("purchases").drop(SOURCE_FILE)


# Columns of every type that inference tells apart, and one without any value.
_TYPED = """
select l_orderkey as small_id, l_orderkey * 10000000000 + l_linenumber as large_id, l_extendedprice / l_quantity as price,
 l_shipdate as shipped, l_returnflag as flag, case when l_linenumber > 1 then l_quantity > 25 end as bulky,
 case when l_linenumber = 1 then cast(l_orderkey as varchar) else l_linestatus end as mixed, cast(null as varchar) as nothing
from lineitem"""


def _whole(column: str) -> str:
    return f"case when max(abs({column})) < 2147483648 then 'int' else 'bigint' end"


@register(
    "infer_schema",
    f"""with typed as ({_TYPED}),
csv as (select {_whole('small_id')} as small_id, {_whole('large_id')} as large_id,
 case when max(abs(price - floor(price))) > 0 then 'double' else 'int' end as price,
 case when typeof(any_value(shipped)) in ('TIMESTAMP', 'DATE') then 'timestamp' else 'string' end as shipped,
 case when bool_and(regexp_full_match(flag, '[0-9]+')) then 'int' else 'string' end as flag,
 lower(typeof(any_value(bulky))) as bulky,
 case when bool_and(regexp_full_match(mixed, '[0-9]+')) then 'int' else 'string' end as mixed,
 case when count(nothing) > 0 then 'other' else 'string' end as nothing from typed),
json as (select 'bigint' as small_id, 'bigint' as large_id, 'double' as price, 'string' as shipped, 'string' as flag,
 'boolean' as bulky, 'string' as mixed)
select 'csv' as file_format, column_name, data_type from (unpivot csv on columns(*) into name column_name value data_type)
union all
select 'json' as file_format, column_name, data_type from (unpivot json on columns(*) into name column_name value data_type)""",
)
def infer(spark: SparkSession, sf: str) -> DataFrame:
    """Types found in CSV text and in JSON lines of the same rows."""
    root = scratch_path(spark, "infer")
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("small_id"),
        (F.col("l_orderkey").cast("bigint") * 10000000000 + F.col("l_linenumber")).alias("large_id"),
        (F.col("l_extendedprice").cast("double") / F.col("l_quantity").cast("double")).alias("price"),
        F.col("l_shipdate").alias("shipped"),
        F.col("l_returnflag").alias("flag"),
        F.when(F.col("l_linenumber") > 1, F.col("l_quantity") > 25).alias("bulky"),
        F.when(F.col("l_linenumber") == 1, F.col("l_orderkey").cast("string"))
        .otherwise(F.col("l_linestatus"))
        .alias("mixed"),
        F.lit(None).cast("string").alias("nothing"),
    )
    found = []
    for file_format in ("csv", "json"):
        write_shards(rows, f"{root}/{file_format}", file_format, 4, "small_id")
        schema = infer_schema(spark, f"{root}/{file_format}", file_format)
        found += [(file_format, f.name, f.dataType.simpleString()) for f in schema.fields]
        # Text of the one format is gone before that of the other is written.
        discard(spark.read.text(f"{root}/{file_format}"))
    return spark.createDataFrame(found, "file_format string, column_name string, data_type string")


@register(
    "schema_evolution",
    with_ctes(
        "raw_customers",
        f"""select customer_id, facility_name, type, region, beds::bigint as beds, ssn_last4_contact,
 case when region in ('ASIA', 'EUROPE') then contract_tier end as contract_tier, {_NO_RESCUE} from raw_customers""",
    ),
)
def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """A second delivery adds a column, which an ordinary run picks up by itself."""
    root = scratch_path(spark, "evolve")
    rows = raw(spark, sf, "customers")
    later = F.col("region").isin("ASIA", "EUROPE")
    house = Lakehouse(spark, f"{root}/tables", f"{root}/landing")
    known = [f for f in DATASETS["customers"].landing_schema.fields if f.name != "contract_tier"]
    house.registry.save("customers", StructType(known))

    def deliver(part: DataFrame, name: str) -> DataFrame:
        write_shards(part, f"{root}/landing/customers/{name}", "json", 2, "customer_id")
        house.load("customers")
        return house.bronze("customers").drop(SOURCE_FILE)

    deliver(rows.filter(~later).drop("contract_tier"), "first")
    return deliver(rows.filter(later), "second")


@register(
    "rescue_json",
    with_ctes(
        "raw_customers",
        """select customer_id, facility_name, type, region,
 case when customer_id % 17 = 3 then null else beds::bigint end as beds, ssn_last4_contact, contract_tier,
 case when customer_id % 17 = 3 and customer_id % 29 = 0 then '{"beds":"n/a","note":"call first"}'
      when customer_id % 17 = 3 then '{"beds":"n/a"}'
      when customer_id % 29 = 0 then '{"note":"call first"}' end as _rescued
from raw_customers""",
    ),
)
def rescue_json(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with a value that is no number and with a field the schema does not know."""
    rows = raw(spark, sf, "customers").withColumns(
        {
            "beds": F.expr("CASE WHEN customer_id % 17 = 3 THEN 'n/a' ELSE CAST(beds AS STRING) END"),
            "note": F.expr("CASE WHEN customer_id % 29 = 0 THEN 'call first' END"),
        }
    )
    lines = rows.select(F.to_json(F.struct("*")).alias("value"))
    return rescue_json_lines(lines, DATASETS["customers"].landing_schema)


@register(
    "rescue_csv",
    with_ctes(
        "raw_parts",
        """select part_id, sku, name, category, manufacturer,
 case when part_id % 19 = 4 then null else list_price_usd end as list_price_usd, weight_kg, hazmat_flag, created_at,
 case when part_id % 19 = 4 then '{"list_price_usd":"on request"}' end as _rescued
from raw_parts""",
    ),
)
def rescue_csv(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files with a cell that is no number."""
    root = scratch_path(spark, "rescue")
    price = "CASE WHEN part_id % 19 = 4 THEN 'on request' ELSE CAST(list_price_usd AS STRING) END"
    rows = raw(spark, sf, "parts").withColumn("list_price_usd", F.expr(price))
    write_shards(rows, f"{root}/landing", "csv", 5, "part_id")
    return _ingest(spark, f"{root}/landing", root, "parts", DATASETS["parts"].landing_schema)


@register("full_refresh", table_sql("silver_suppliers"))
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """An incremental run, then a full one: the second holds the same rows once."""
    root = scratch_path(spark, "refresh")
    _land(spark, sf, "suppliers", root)
    lakehouse = Lakehouse(spark, f"{root}/tables", f"{root}/landing")
    lakehouse.refresh_dataset("suppliers", register=False)
    return lakehouse.refresh_dataset("suppliers", full=True, register=False)


@register(
    "shard_roundtrip_csv",
    with_ctes(
        "raw_work_orders",
        """select work_order_id, part_id, customer_id, strftime(opened_at, '%Y-%m-%d %H:%M:%S') as opened_at,
 strftime(closed_at, '%Y-%m-%d %H:%M:%S') as closed_at, status, priority, technician_notes from raw_work_orders""",
    ),
)
def shard_roundtrip_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Five CSV shards, read back as text but for the ids."""
    path = _land(spark, sf, "work_orders", scratch_path(spark, "shards-csv"))
    schema = (
        "work_order_id bigint, part_id bigint, customer_id bigint, opened_at string, "
        "closed_at string, status string, priority string, technician_notes string"
    )
    return spark.read.schema(schema).option("header", True).csv(path)


@register("shard_roundtrip_json", with_ctes("raw_suppliers", "select * from raw_suppliers"))
def shard_roundtrip_json(spark: SparkSession, sf: str) -> DataFrame:
    """Three NDJSON shards, read back."""
    path = _land(spark, sf, "suppliers", scratch_path(spark, "shards-json"))
    return spark.read.schema(raw(spark, sf, "suppliers").schema).json(path)


# --- generated data, with row ids taken from the test tables ----------------------------

_ID_SOURCES = {
    "parts": ("part", "p_partkey"),
    "suppliers": ("supplier", "s_suppkey"),
    "customers": ("customer", "c_custkey"),
    "work_orders": ("orders", "o_orderkey"),
    "purchases": ("lineitem", "l_orderkey * 10 + l_linenumber"),
    "inventory": ("events", "event_id"),
}
for _name, (_table, _id) in _ID_SOURCES.items():
    register(f"gen_{_name}", generated(_name, f"select {_id} as id from {_table}"))(
        lambda spark, sf, d=_name, t=_table, i=_id: generate.GENERATORS[d](
            table(spark, sf, t).select(F.expr(i).alias(generate.ID))
        )
    )
