"""Registered queries for masks, snapshot changes and similarity search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.checks.queries import performance, register, silver
from opslake.checks.sql import with_ctes
from opslake.functions import masking
from opslake.operators import search
from opslake.operators.cells import CellIndex
from opslake.operators.diff import snapshot_diff
from opslake.operators.embedding import HashedWordEmbedder, sync_segments
from opslake.operators.governance import (
    COLUMN_MASKS,
    COLUMN_TAGS,
    PII_VIEWERS,
    certify,
    masked_view,
    publish_masked_view,
    tag_columns,
)
from opslake.operators.governance import tag_coverage as governance_tag_coverage
from opslake.operators.text_index import TextIndex
from opslake.plans import parts
from opslake.session import scratch_path
from opslake.sources.catalog import create_namespaces, materialize
from opslake.sources.segments import SegmentedTable
from opslake.sources.test_tables import table

# --- masks -----------------------------------------------------------------------------

_TAX = "'***-*' || right(tax_id, 4)"
_MAIL = "'***@' || split(contact_email, '@')[2]"


@register("mask_tax_id", with_ctes("silver_suppliers", f"select supplier_id, {_TAX} as masked from silver_suppliers"))
def mask_tax_id(spark: SparkSession, sf: str) -> DataFrame:
    masked = masking.mask_tax_id(F.col("tax_id")).alias("masked")
    return silver(spark, sf, "suppliers").select("supplier_id", masked)


@register("mask_email", with_ctes("silver_suppliers", f"select supplier_id, {_MAIL} as masked from silver_suppliers"))
def mask_email(spark: SparkSession, sf: str) -> DataFrame:
    masked = masking.mask_email(F.col("contact_email")).alias("masked")
    return silver(spark, sf, "suppliers").select("supplier_id", masked)


@register("mask_ssn", with_ctes("silver_customers", "select customer_id, 'XXXX' as masked from silver_customers"))
def mask_ssn(spark: SparkSession, sf: str) -> DataFrame:
    masked = masking.mask_ssn(F.col("ssn_last4_contact")).alias("masked")
    return silver(spark, sf, "customers").select("customer_id", masked)


@register(
    "masked_suppliers",
    with_ctes(
        "silver_suppliers",
        f"select * replace ({_TAX} as tax_id, {_MAIL} as contact_email) from silver_suppliers",
    ),
)
def masked_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return _masked_in_catalog(spark, sf, "suppliers", "suppliers.silver_suppliers")


def _masked_in_catalog(spark: SparkSession, sf: str, dataset: str, name: str) -> DataFrame:
    """The masked view of a silver table, as a session that has just begun finds it."""
    create_namespaces(spark)
    materialize(silver(spark, sf, dataset), name, scratch_path(spark, "masked"))
    view = publish_masked_view(spark, name, COLUMN_MASKS[name])
    return spark.newSession().table(view)


@register("unmasked_suppliers", with_ctes("silver_suppliers", "select * from silver_suppliers"))
def unmasked_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    masks = COLUMN_MASKS["suppliers.silver_suppliers"]
    return masked_view(silver(spark, sf, "suppliers"), masks, [PII_VIEWERS])


@register(
    "masked_customers",
    with_ctes(
        "silver_customers", "select * replace ('XXXX' as ssn_last4_contact) from silver_customers"
    ),
)
def masked_customers(spark: SparkSession, sf: str) -> DataFrame:
    return _masked_in_catalog(spark, sf, "customers", "service_ops.silver_customers")


_TAGGED = """
select 'suppliers.silver_suppliers' as object, 'tax_id' as "column", 'pii' as tag, 'true' as value, count(tax_id) as filled from silver_suppliers
union all select 'suppliers.silver_suppliers', 'tax_id', 'classification', 'restricted', count(tax_id) from silver_suppliers
union all select 'suppliers.silver_suppliers', 'contact_email', 'pii', 'true', count(contact_email) from silver_suppliers
union all select 'suppliers.silver_suppliers', 'contact_email', 'classification', 'confidential', count(contact_email) from silver_suppliers
union all select 'suppliers.gold_supplier_performance', null, 'certified', 'true', count(*) from gold_supplier_performance
union all select 'suppliers.gold_supplier_performance', null, 'domain', 'suppliers', count(*) from gold_supplier_performance
union all select 'suppliers.gold_supplier_performance', null, 'steward', 'supply_chain_team', count(*) from gold_supplier_performance"""


@register("tag_coverage", with_ctes("silver_suppliers gold_supplier_performance", _TAGGED.strip()))
def tag_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of a silver table's columns and of a gold table, and how much of them is filled."""
    create_namespaces(spark)
    root = scratch_path(spark, "tagged")
    names = ["suppliers.silver_suppliers", "suppliers.gold_supplier_performance"]
    rows = silver(spark, sf, "suppliers")
    materialize(tag_columns(rows, COLUMN_TAGS[names[0]]), names[0], root)
    materialize(performance(spark, sf), names[1], root)
    certify(spark, names[1])
    # Tags that other runs set beside these, such as a table's layer, are not asked for.
    found = governance_tag_coverage(spark, names)
    return found.where(~F.col("tag").isin("layer") & (F.col("column").isNotNull() | F.col("object").like("%.gold%")))


# --- snapshots of the searchable table --------------------------------------------------

# The later snapshot: some parts gone, some with a new price and text, some new.
_LATER = """
select part_id, sku, part_name, category, manufacturer,
 case when part_id % 7 = 0 then list_price_usd * 2 else list_price_usd end as list_price_usd, hazmat_flag,
 case when part_id % 7 = 0 then description || ' (new price)' else description end as description
from parts_searchable where part_id % 11 <> 0
union all
select part_id + 100000000, sku, part_name, category, manufacturer, list_price_usd, hazmat_flag, description
from parts_searchable where part_id % 13 = 0"""


def _snapshots(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    old = parts.parts_searchable(silver(spark, sf, "parts"))
    repriced = F.col("part_id") % 7 == 0
    stayed = old.filter(F.col("part_id") % 11 != 0).withColumns(
        {
            "list_price_usd": F.when(repriced, F.col("list_price_usd") * 2).otherwise(
                F.col("list_price_usd")
            ),
            "description": F.when(
                repriced, F.concat("description", F.lit(" (new price)"))
            ).otherwise(F.col("description")),
        }
    )
    added = old.filter(F.col("part_id") % 13 == 0).withColumn(
        "part_id", F.col("part_id") + F.lit(100000000).cast("bigint")
    )
    return old, stayed.unionByName(added)


@register(
    "snapshot_diff",
    with_ctes(
        "parts_searchable",
        f"""select case when o.part_id is null then 'insert' when n.part_id is null then 'delete' else 'update' end as change,
 coalesce(n.part_id, o.part_id) as part_id,
 case when n.part_id is null then o.sku else n.sku end as sku,
 case when n.part_id is null then o.part_name else n.part_name end as part_name,
 case when n.part_id is null then o.category else n.category end as category,
 case when n.part_id is null then o.manufacturer else n.manufacturer end as manufacturer,
 case when n.part_id is null then o.list_price_usd else n.list_price_usd end as list_price_usd,
 case when n.part_id is null then o.hazmat_flag else n.hazmat_flag end as hazmat_flag,
 case when n.part_id is null then o.description else n.description end as description
from parts_searchable o full outer join ({_LATER}) n on o.part_id = n.part_id
where o.part_id is null or n.part_id is null or o.list_price_usd is distinct from n.list_price_usd
 or o.description is distinct from n.description""",
    ),
)
def diff(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_diff(*_snapshots(spark, sf), key="part_id")


# --- similarity search ------------------------------------------------------------------


# Words of the descriptions with their weights, as SQL: tf times ln((n + 1) / (df + 1)), scaled.
_WORDS_SQL = r"""
words as (select part_id, unnest(regexp_extract_all(lower(description), '\p{L}+')) as word from parts_searchable),
tf as (select part_id, ('0x' || substr(md5(word), 1, 15))::bigint as token, count(*) as tf from words group by part_id, word),
size as (select count(*) as n from parts_searchable),
df as (select token, count(*) as df from tf group by token),
raw as (select part_id, token, tf * ln((n + 1)::double / (df + 1)) as w from tf join df using (token), size where df < n),
norms as (select part_id, sqrt(sum(w * w)) as norm from raw group by part_id)"""


@register(
    "embed_index",
    with_ctes(
        "parts_searchable",
        f"""select part_id, token, round(w / norm, 9) as weight
from (with {_WORDS_SQL.strip()} select * from raw join norms using (part_id))""",
    ),
)
def embed_index(spark: SparkSession, sf: str) -> DataFrame:
    """The postings of the catalogue's inverted index."""
    index = _text_index(spark, sf)
    return index.postings().select("part_id", "token", F.round("weight", 9).alias("weight"))


def _text_index(spark: SparkSession, sf: str) -> TextIndex:
    catalogue = parts.parts_searchable(silver(spark, sf, "parts"))
    path = scratch_path(spark, "text-index")
    return TextIndex.build(catalogue, "part_id", "description", path, parts.SHOWN)


# A third snapshot: as the second, and some parts with a new price and the old text.
_SYNCED = f"""
select * replace (case when part_id % 5 = 0 then list_price_usd + 1 else list_price_usd end as list_price_usd) from ({_LATER})"""


@register(
    "sync_index",
    with_ctes(
        "parts_searchable",
        rf"""select part_id, list_price_usd, segment, place, weight from (
with rows as (
 select n.part_id, n.list_price_usd, n.description,
  case when o.part_id is null or o.description <> n.description then 'later' else 'first' end as salt,
  case when o.part_id is null or o.description <> n.description or o.list_price_usd is distinct from n.list_price_usd
   then 1 else 0 end as segment
 from ({_SYNCED}) n left join parts_searchable o on o.part_id = n.part_id),
words as (select *, unnest(regexp_extract_all(lower(description), '\p{{L}}+')) || salt as word from rows),
counts as (select part_id, list_price_usd, segment, ('0x' || substr(md5(word), 1, 15))::bigint % 64 as place, count(*) as c
 from words group by all)
select part_id, list_price_usd, segment, place::int as place,
 round((c / sqrt(sum(c * c) over (partition by part_id)))::float::double, 6) as weight from counts)""",
    ),
)
def sync_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index in segments after a second sync: the base holds what didn't change, a segment the
    rest. The second sync embeds with another salt, so a vector tells which sync made it."""
    old, new = _snapshots(spark, sf)
    price = F.when(F.col("part_id") % 5 == 0, F.col("list_price_usd") + 1)
    new = new.withColumn("list_price_usd", F.coalesce(price, "list_price_usd"))
    index = SegmentedTable(spark, scratch_path(spark, "segments"), "part_id")
    sync_segments(index, old, HashedWordEmbedder(salt="first"), "description")
    sync_segments(index, new, HashedWordEmbedder(salt="later"), "description")
    cells = index.read(["part_id", "list_price_usd", "embedding"], numbered=True).select(
        "part_id", "list_price_usd", "segment", F.posexplode("embedding").alias("place", "x")
    )
    weight = F.round(F.col("x").cast("double"), 6).alias("weight")
    return cells.where("x > 0").select("part_id", "list_price_usd", "segment", "place", weight)


def _centroids(spark: SparkSession, sf: str) -> DataFrame:
    """One query per label: the mean of its vectors."""
    cells = table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("at", "x"))
    means = cells.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))
    return means.groupBy(F.col("label").alias("query_id")).agg(
        F.transform(ordered, lambda cell: cell["x"]).alias("embedding")
    )


@register(
    "vector_topk",
    """with cells as (select label, generate_subscripts(embedding, 1) as pos, unnest(embedding)::double as x from embeddings),
means as (select label, pos, avg(x) as x from cells group by label, pos),
queries as (select label as query_id, list(x order by pos) as q from means group by label),
scored as (select query_id, vec_id, label, round(list_cosine_similarity(embedding::double[], q), 9) as score
 from embeddings cross join queries),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, label, score
 from scored)
select * from ranked where rank <= 5""",
)
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    index = table(spark, sf, "embeddings")
    return search.search(index, _centroids(spark, sf), 5, ["label"], key="vec_id")


@register("vector_topk_lsh")
def vector_topk_lsh(spark: SparkSession, sf: str) -> DataFrame:
    index = table(spark, sf, "embeddings")
    lsh = search.LshBuckets.fit(index)
    return search.search_approx(
        lsh.assign(index), _centroids(spark, sf), lsh, 5, ["label"], key="vec_id"
    )


@register("vector_topk_cells")
def vector_topk_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Five neighbours of every hundredth part by its description, from an index by cells."""
    catalogue = parts.parts_searchable(silver(spark, sf, "parts"))
    rows = HashedWordEmbedder().transform(catalogue, "description")
    index = CellIndex.build(rows, scratch_path(spark, "cells"), "part_id")
    asked = index.rows().where("part_id % 100 = 0")
    asked = asked.select(F.col("part_id").alias("query_id"), "embedding")
    return index.search(asked, 5, parts.SHOWN)


@register(
    "text_topk",
    with_ctes(
        "parts_searchable",
        rf"""select * from (
with {_WORDS_SQL.strip()},
asked as (select category as query_id,
  unnest(regexp_extract_all(lower('hazardous ' || category || ' replacement parts'), '\p{{L}}+')) as word
 from (select distinct category from parts_searchable)),
asked_tf as (select query_id, ('0x' || substr(md5(word), 1, 15))::bigint as token, count(*) as tf from asked group by query_id, word),
asked_raw as (select query_id, token, tf * ln((n + 1)::double / (coalesce(df, 0) + 1)) as q
 from asked_tf left join df using (token), size),
asked_norm as (select query_id, sqrt(sum(q * q)) as q_norm from asked_raw group by query_id),
scored as (select query_id, part_id, round(sum(w / norm * (q / q_norm)), 9) as score
 from asked_raw join asked_norm using (query_id) join raw using (token) join norms using (part_id) group by query_id, part_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, part_id)::int as rank from scored)
select query_id, rank, part_id, sku, part_name, category, manufacturer, list_price_usd, score
from ranked join parts_searchable using (part_id) where rank <= 5)""",
    ),
)
def text_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The five closest parts to a sentence about each category, by the inverted index."""
    index = _text_index(spark, sf)
    asked = index.texts().select(F.col("category").alias("query_id")).distinct().withColumn(
        "query_text", F.concat(F.lit("hazardous "), F.lower("query_id"), F.lit(" replacement parts"))
    )
    return index.search(asked, 5, columns=parts.SHOWN)
