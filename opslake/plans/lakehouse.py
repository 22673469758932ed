"""Landing files to gold tables, feeds and index, as ordinary Spark jobs in a fixed order.

Bronze and silver are streaming tables: each run picks up the files and rows that are new.
Gold tables are recomputed from all of silver, so late rows count with the next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.functions.business import URGENT_SHORTFALL
from opslake.operators.embedding import TextEmbedder, TfIdfEmbedder, sync_segments
from opslake.operators.governance import (
    COLUMN_MASKS,
    COLUMN_TAGS,
    certify_gold,
    publish_masked_view,
    tag_columns,
)
from opslake.operators.quality import EVENT_LOG_SCHEMA
from opslake.operators.search import search_text
from opslake.plans import feeds, parts, service_ops, suppliers
from opslake.plans.contracts import Dataset
from opslake.plans.domains import DATASETS, DOMAINS
from opslake.plans.metrics import METRIC_VIEWS, METRICS
from opslake.sources.catalog import (
    create_namespaces,
    materialize,
    publish_view,
    register_table,
    tag_table,
)
from opslake.sources.rescue import bronze_schema
from opslake.sources.schemas import RegisteredSchema, SchemaRegistry
from opslake.sources.segments import SegmentedTable
from opslake.streaming.deliveries import load_bronze, load_silver, read_batches, stream_batches

INDEX_TABLE = "parts.parts_searchable_index"
INDEX_TEXT = "description"
FEED_TAGS = {
    "reverse_etl.reorder_alerts_feed": {"domain": "parts", "sink": "operational_store"},
    "reverse_etl.supplier_tier_feed": {"domain": "suppliers", "sink": "operational_store"},
}


@dataclass(frozen=True)
class GoldTable:
    name: str
    comment: str
    build: Callable[[SparkSession, datetime | str | None], DataFrame]


def _gold_tables() -> dict[str, list[GoldTable]]:
    def t(spark: SparkSession, name: str) -> DataFrame:
        return spark.table(name)

    return {
        "suppliers": [
            GoldTable(
                "suppliers.gold_supplier_performance",
                "Score, spend and last purchase of each supplier",
                lambda s, _: suppliers.gold_supplier_performance(
                    t(s, "suppliers.silver_suppliers"), t(s, "suppliers.silver_purchases")
                ),
            ),
            GoldTable(
                "suppliers.gold_spend_by_region",
                "Spend and suppliers by region and tier",
                lambda s, _: suppliers.gold_spend_by_region(
                    t(s, "suppliers.gold_supplier_performance")
                ),
            ),
        ],
        "parts": [
            GoldTable(
                "parts.gold_part_pricing_benchmark",
                "List against paid price of each part",
                lambda s, _: parts.gold_part_pricing_benchmark(
                    t(s, "parts.silver_parts"), t(s, "suppliers.silver_purchases")
                ),
            ),
            GoldTable(
                "parts.gold_reorder_needed",
                "Stock at or below its reorder point",
                lambda s, as_of: parts.gold_reorder_needed(
                    t(s, "parts.silver_inventory"), t(s, "parts.silver_parts"), as_of
                ),
            ),
            GoldTable(
                "parts.parts_searchable",
                "Catalogue with the text that similarity search embeds",
                lambda s, _: parts.parts_searchable(t(s, "parts.silver_parts")),
            ),
        ],
        "service_ops": [
            GoldTable(
                "service_ops.gold_work_order_volume",
                "Work orders by month, priority and status",
                lambda s, _: service_ops.gold_work_order_volume(
                    t(s, "service_ops.silver_work_orders")
                ),
            ),
            GoldTable(
                "service_ops.gold_part_demand_monthly",
                "Work orders and their mean duration by part and month",
                lambda s, _: service_ops.gold_part_demand_monthly(
                    t(s, "service_ops.silver_work_orders")
                ),
            ),
            GoldTable(
                "service_ops.gold_sla_performance",
                "SLA attainment by priority",
                lambda s, _: service_ops.gold_sla_performance(
                    t(s, "service_ops.silver_work_orders")
                ),
            ),
        ],
    }


class Lakehouse:
    """All tables under one root folder on shared storage, landing files under another."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        landing: str,
        max_bytes_per_trigger: str | None = None,
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.landing = landing.rstrip("/")
        self.max_bytes_per_trigger = max_bytes_per_trigger
        self.registry = SchemaRegistry(spark, f"{self.root}/_schemas")
        self.event_log_path = f"{self.root}/_event_log"
        self.model_path = f"{self.root}/_models/tfidf"

    def _paths(self, spec: Dataset, layer: str, generation: int) -> tuple[str, str]:
        table = f"{self.root}/{spec.domain}/{layer}_{spec.name}/generation={generation}"
        checkpoint = f"{self.root}/_checkpoints/{layer}_{spec.name}/generation={generation}"
        return table, checkpoint

    def load(self, dataset: str, full: bool = False) -> RegisteredSchema:
        """Bring one dataset's bronze up to date; returns its schema, with the columns that new
        files brought. ``full`` starts a new generation."""
        spec = DATASETS[dataset]
        known = self.registry.load(dataset) or self.registry.save(dataset, spec.landing_schema)
        if full:
            known = self.registry.save(dataset, known.schema, known.generation + 1)
        bronze, checkpoint = self._paths(spec, "bronze", known.generation)
        landing = f"{self.landing}/{dataset}"
        return load_bronze(
            self.spark,
            dataset,
            spec.file_format,
            landing,
            bronze,
            checkpoint,
            self.registry,
            self.max_bytes_per_trigger,
        )

    def bronze(self, dataset: str) -> DataFrame:
        """The rows of a dataset as delivered, with rescued values and source file."""
        known = self.registry.load(dataset)
        path, _ = self._paths(DATASETS[dataset], "bronze", known.generation)
        return read_batches(self.spark, path, bronze_schema(known.schema))

    def refresh_dataset(
        self, dataset: str, full: bool = False, run_id: str = "", register: bool = True
    ) -> DataFrame:
        """Bring one dataset's bronze and silver tables up to date; returns silver.

        ``full`` starts a new generation: new folders and checkpoints, filled from every
        landing file. The tables move to it once it is complete; the old one stays on disk.
        ``register=False`` leaves the catalog alone.
        """
        spark, spec = self.spark, DATASETS[dataset]
        known = self.load(dataset, full)
        generation, schema = known.generation, bronze_schema(known.schema)
        bronze, _ = self._paths(spec, "bronze", generation)

        silver, silver_checkpoint = self._paths(spec, "silver", generation)
        name = f"{spec.domain}.silver_{dataset}"

        def project(rows: DataFrame) -> DataFrame:
            return tag_columns(spec.project(rows), COLUMN_TAGS.get(name, {}))

        load_silver(
            stream_batches(spark, bronze, schema, self.max_bytes_per_trigger),
            project,
            spec.expectations,
            silver,
            silver_checkpoint,
            f"{self.event_log_path}/dataset={dataset}/generation={generation}",
            dataset,
            run_id,
        )
        silver_schema = project(read_batches(spark, bronze, schema)).schema
        rows = read_batches(spark, silver, silver_schema)
        if not register:
            return rows
        properties = {"domain": spec.domain}
        register_table(
            spark,
            f"{spec.domain}.bronze_{dataset}",
            bronze,
            schema,
            f"{dataset} as delivered, with rescued values",
            {**properties, "layer": "bronze"},
        )
        register_table(
            spark,
            name,
            silver,
            silver_schema,
            f"{dataset} typed and checked",
            {**properties, "layer": "silver"},
        )
        return rows

    def run_domain(
        self,
        domain: str,
        as_of: datetime | str | None = None,
        full: bool = False,
        run_id: str = "",
    ) -> None:
        """Bronze and silver of the domain's datasets, then its gold tables."""
        for spec in DATASETS.values():
            if spec.domain == domain:
                self.refresh_dataset(spec.name, full, run_id)
        for gold in _gold_tables()[domain]:
            materialize(
                gold.build(self.spark, as_of),
                gold.name,
                f"{self.root}/gold",
                gold.comment,
                {"domain": domain, "layer": "gold"},
            )

    def publish_if_alerts(self, as_of: datetime | str | None = None) -> int:
        """Replace both feeds when there are urgent reorders; else leave the last good ones."""
        spark = self.spark
        count = spark.sql(
            "SELECT count(*) AS n FROM IDENTIFIER(:reorder) WHERE shortfall_qty > :urgent",
            args={"reorder": "parts.gold_reorder_needed", "urgent": URGENT_SHORTFALL},
        ).head()["n"]
        if count > 0:
            reorder = spark.table("parts.gold_reorder_needed")
            built: Mapping[str, DataFrame] = {
                "reverse_etl.reorder_alerts_feed": feeds.reorder_alerts_feed(reorder, as_of),
                "reverse_etl.supplier_tier_feed": feeds.supplier_tier_feed(
                    spark.table("suppliers.gold_supplier_performance"), as_of
                ),
            }
            for name, df in built.items():
                materialize(df, name, f"{self.root}/feeds")
                tag_table(spark, name, {"reverse_etl": "true", **FEED_TAGS[name]})
        return count

    def search_index(self) -> SegmentedTable:
        """The index of the searchable table, in segments."""
        return SegmentedTable(self.spark, f"{self.root}/index/{INDEX_TABLE}", "part_id")

    def sync_search_index(
        self, embedder: TextEmbedder | None = None, compact: bool = False
    ) -> DataFrame:
        """Embed what is new or changed in the searchable table; returns the index table.

        Only changes are written, as a segment; ``compact`` folds all segments into a new base.
        Without an ``embedder`` the first sync fits TF-IDF on the descriptions and keeps the
        model; later syncs and searches load it, so all vectors come from one model.
        """
        spark, index = self.spark, self.search_index()
        source = spark.table("parts.parts_searchable")
        known = index.manifest()
        if embedder is None:
            if known is None:
                TfIdfEmbedder.fit(source, INDEX_TEXT).save(self.model_path)
            embedder = TfIdfEmbedder.load(self.model_path)
        sync_segments(index, source, embedder, INDEX_TEXT)
        if compact:
            index.compact()
        if index.manifest() != known or not spark.catalog.tableExists(INDEX_TABLE):
            publish_view(
                spark, INDEX_TABLE, index.sql(), "Embedded descriptions of the parts", {"domain": "parts"}
            )
        return spark.table(INDEX_TABLE)

    def search_parts(
        self, queries: DataFrame, k: int = 5, embedder: TextEmbedder | None = None
    ) -> DataFrame:
        """The k closest parts for each (query_id, query_text), the score last."""
        return search_text(
            self.spark.table(INDEX_TABLE),
            queries,
            embedder or TfIdfEmbedder.load(self.model_path),
            k=k,
            columns=parts.SHOWN,
        )

    def govern(self) -> None:
        """Certify the gold tables, publish the metric views and mask the personal columns."""
        certify_gold(self.spark)
        for view in METRIC_VIEWS.values():
            view.publish(self.spark, METRICS, f"{self.root}/metrics")
        tag_table(
            self.spark, "parts.parts_searchable", {"purpose": "similarity_search_source"}
        )
        for name, masks in COLUMN_MASKS.items():
            publish_masked_view(self.spark, name, masks)

    def event_log(self) -> DataFrame:
        """Passed and failed counts per run, dataset and expectation."""
        reader = self.spark.read.schema(EVENT_LOG_SCHEMA).option("recursiveFileLookup", True)
        batches = reader.parquet(self.event_log_path)
        return batches.groupBy("run_id", "dataset", "expectation", "action").agg(
            F.sum("passed").alias("passed"), F.sum("failed").alias("failed")
        )

    def run(self, as_of: datetime | str | None = None, full: bool = False) -> DataFrame:
        """Everything in order; returns the published batch or, without alerts, the summary."""
        spark = self.spark
        run_id = uuid.uuid4().hex
        create_namespaces(spark)
        for domain in DOMAINS:
            self.run_domain(domain, as_of, full, run_id)
        self.govern()
        self.sync_search_index()
        if self.publish_if_alerts(as_of):
            return feeds.alert_batch_summary(spark.table("reverse_etl.reorder_alerts_feed"))
        return feeds.clean_run_summary(
            spark.table("parts.gold_reorder_needed"),
            spark.table("suppliers.gold_supplier_performance"),
        )
