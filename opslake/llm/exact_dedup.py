"""Exact duplicates by deterministic block naming.

A text is cut into blocks of fixed size. Equal blocks get one integer name by sorting, then
adjacent names are paired and the pairs named by sorting again, level by level, until one
name is left per document. Two documents share level and name exactly when their texts are
equal: every name stands for one content, at every level.

Block contents are shuffled once, combined before the shuffle, to see which hashes stand for
more than one content; names are then joined by hash, and by hash and content where a hash
is shared. What moves afterwards is integers. Copies of one text meet only in aggregates
that combine first and in joins that the adaptive skew join can split.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import ROW, lower_ascii, number_sorted, stored, with_row

BLOCK_BYTES = 4096


def _blocks(data: Column, size: int) -> Column:
    """The blocks of a binary column; an empty one has one empty block."""
    count = F.greatest(F.lit(1), F.ceil(F.octet_length(data) / size).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(data, i * size + 1, F.lit(size))
    )


def _rank_shared(distinct: DataFrame, shared: DataFrame) -> DataFrame:
    """Of the few blocks whose hash other blocks have as well: their order by content."""
    by_content = Window.partitionBy("hash").orderBy("block")
    among = distinct.join(shared, "hash", "left_semi")
    return among.select("hash", "block", F.row_number().over(by_content).alias("rank"))


def block_names(
    docs: DataFrame,
    text_col: str = "text",
    carry: Sequence[str] = (),
    block_bytes: int = BLOCK_BYTES,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: ``__row``, the carried columns, and the identity of the
    text in ``level`` and ``name``.

    Texts are compared after lower-casing A-Z; null counts as empty. Empty texts share one
    identity. An empty table gives no rows. Other columns of ``docs`` are left out.
    """
    source = with_row(docs)
    norm = lower_ascii(F.coalesce(F.col(text_col), F.lit("")))
    blocks = _blocks(norm.cast("binary"), block_bytes)
    hashes = F.transform(blocks, lambda block: block_hash(block))
    texts = stored(source.select(ROW, *carry, hashes.alias("hashes")), "block-hashes")

    block = source.select(ROW, F.posexplode(blocks).alias("pos", "block"))
    block = block.withColumn("hash", block_hash(F.col("block")))
    distinct = block.select("hash", "block").distinct()
    shared = stored(distinct.groupBy("hash").count().where("count > 1").select("hash"), "shared")
    nodes = texts.select(ROW, F.posexplode("hashes").alias("pos", "hash"))
    if shared.isEmpty():
        nodes = nodes.withColumn("rank", F.lit(0))
    else:
        ranks = _rank_shared(distinct, shared)
        ranked = block.join(ranks, ["hash", "block"]).select(ROW, "pos", "rank")
        nodes = nodes.join(ranked, [ROW, "pos"], "left").fillna(0, ["rank"])
        nodes = stored(nodes, "ranked-blocks")

    depth = math.ceil(math.log2(texts.agg(F.max(F.size("hashes"))).first()[0] or 1))
    pair = ["hash", "rank"]
    size = F.size("hashes")
    done: DataFrame | None = None
    for level in range(depth + 1):
        names = number_sorted(nodes, f"names-{level}", *pair)
        match = [nodes[c].eqNullSafe(names[c]) for c in pair]
        nodes = nodes.join(names, match).select(ROW, "pos", "name")
        if level < depth:
            nodes = stored(nodes, f"nodes-{level}")
        # Texts of up to 2**level blocks, but of more than half as many, have one name now.
        complete = texts.where((size <= 2**level) & (size > 2**level // 2)).select(ROW)
        ended = nodes.join(complete, ROW, "left_semi").select(
            ROW, F.lit(level).alias("level"), "name"
        )
        done = ended if done is None else done.unionByName(ended)
        if level < depth:
            nodes = nodes.join(texts.where(size > 2**level).select(ROW), ROW, "left_semi")
            half = F.col("pos") % 2
            nodes = nodes.groupBy(ROW, F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
                F.max(F.when(half == 0, F.col("name"))).alias("left"),
                F.max(F.when(half == 1, F.col("name"))).alias("right"),
            )
            nodes, pair = stored(nodes, f"pairs-{level}"), ["left", "right"]
    return texts.drop("hashes").join(done, ROW)


def exact_dedup(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    carry: Sequence[str] = (),
    block_bytes: int = BLOCK_BYTES,
    block_hash: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """One row per row of ``docs``: ``__row``, the id, the carried columns, ``keep_id``,
    ``group_size`` and ``kept``.

    Of equal texts the row with the largest id stays, null being the smallest id; of rows
    that share that id as well, the last in storage order. So one row per group stays, also
    among repeated rows and null ids.
    """
    carried = [c for c in carry if c != id_col]
    named = stored(
        block_names(docs, text_col, [id_col, *carried], block_bytes, block_hash), "named"
    )
    best = F.max(F.struct(F.col(id_col).alias("id"), F.col(ROW).alias("row")))
    groups = named.groupBy("level", "name").agg(
        best.alias("best"), F.count(F.lit(1)).alias("group_size")
    )
    # Written, so that the join deals both sides anew and can split a large group.
    groups = stored(groups, "text-groups")
    return named.join(groups, ["level", "name"]).select(
        ROW,
        id_col,
        *carried,
        F.col("best.id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.col("best.row")).alias("kept"),
    )
