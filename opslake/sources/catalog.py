"""Namespaces, table writes with their comments and properties, and snapshot publishing."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# The namespaces and what they hold.
NAMESPACES = {
    "raw": "Landing files as delivered",
    "suppliers": "Suppliers and purchases: bronze, silver and gold",
    "parts": "Parts, inventory and prices: bronze, silver and gold",
    "service_ops": "Facilities and work orders: bronze, silver and gold",
    "business_metrics": "Metric views over the gold tables",
    "reverse_etl": "Feeds that operational systems read",
}


# Properties of a view that stands for a table: the table with its files now, and before.
FILES_OF, FILES_BEFORE = "files_of", "files_before"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _pairs(values: Mapping[str, str]) -> str:
    return ", ".join(f"{_text(k)} = {_text(v)}" for k, v in values.items())


def create_namespaces(spark: SparkSession, root: str | None = None) -> None:
    """Create the six namespaces; running it again changes nothing."""
    for name, comment in NAMESPACES.items():
        location = f" LOCATION {_text(f'{root}/{name}')}" if root else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} COMMENT {_text(comment)}{location}")


def register_table(
    spark: SparkSession,
    name: str,
    path: str,
    schema: StructType,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Let ``name`` show the parquet files under ``path``. Moves no data and deletes none.

    ``name`` is a view of a table that has the files. With the same schema that table gets the new
    location; with another one a new table is made and the view replaced. Each is one step, so
    readers see the old or the new rows and are never without a table. The table before the last
    stays for readers that have just looked it up; older ones leave the catalog.
    """
    kept = _view_properties(spark, name)
    current = kept.get(FILES_OF)
    if current and spark.catalog.tableExists(current) and spark.table(current).schema == schema:
        spark.sql(f"ALTER TABLE {current} SET LOCATION {_text(path)}")
        spark.catalog.refreshTable(current)
    else:
        old, current = current, f"{name}__{uuid.uuid4().hex[:12]}"
        spark.catalog.createTable(
            current, path=path, source="parquet", schema=schema, recursiveFileLookup="true"
        )
        if kept.get(FILES_BEFORE):
            spark.sql(f"DROP TABLE IF EXISTS {kept[FILES_BEFORE]}")
        kept = {**kept, FILES_OF: current, **({FILES_BEFORE: old} if old else {})}
    if not comment and spark.catalog.tableExists(name):
        comment = spark.catalog.getTable(name).description or ""
    publish_view(spark, name, f"SELECT * FROM {current}", comment, {**kept, **(properties or {})})


def materialize(
    df: DataFrame,
    name: str,
    root: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Replace table ``name`` by ``df`` and return the new table.

    Every run writes a folder of its own and then repoints the table. A failed run leaves the
    last good snapshot in place, and ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    path = f"{root}/{name.replace('.', '/')}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    register_table(spark, name, path, df.schema, comment, properties)
    return spark.table(name)


def publish_view(
    spark: SparkSession,
    name: str,
    query: str,
    comment: str = "",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Create or replace a persistent view in one step; readers see the old or the new query. A
    table of that name, from before it was a view, is dropped from the catalog."""
    if spark.catalog.tableExists(name) and not _is_view(spark, name):
        spark.sql(f"DROP TABLE {name}")
    said = f" COMMENT {_text(comment)}" if comment else ""
    kept = f" TBLPROPERTIES ({_pairs(properties)})" if properties else ""
    spark.sql(f"CREATE OR REPLACE VIEW {name}{said}{kept} AS {query}")


def tag_table(spark: SparkSession, name: str, tags: Mapping[str, str]) -> None:
    """Set tags on a table or view as its properties; existing ones are overwritten."""
    kind = "VIEW" if _is_view(spark, name) else "TABLE"
    spark.sql(f"ALTER {kind} {name} SET TBLPROPERTIES ({_pairs(tags)})")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    unlike = ("option.", "view.")
    return {
        r["key"]: r["value"]
        for r in rows
        if not r["key"].startswith(unlike) and r["key"] not in ("comment", "transient_lastDdlTime")
    }


def _view_properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties of a view, those that say where its files are included; none for others."""
    if not spark.catalog.tableExists(name) or not _is_view(spark, name):
        return {}
    return _properties(spark, name)


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties of one table or view, without those that Spark or this module adds."""
    found = _properties(spark, name)
    return {k: v for k, v in found.items() if k not in (FILES_OF, FILES_BEFORE)}
