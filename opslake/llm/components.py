"""Connected components of a link table, by alternating star operations.

Every round rewrites the links: the large star joins each node's larger neighbours to the
smallest node around it, the small star does so for the smaller ones. Rounds end when the
links no longer change; then every link points to the smallest node of its component. The
number of rounds grows with the logarithm of the longest path. Each round is a written
table, so lineage stays short; nothing is gathered on the driver but a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``u`` and ``v``, with ``v`` the smaller end, rewired towards the smallest neighbour."""
    if large:
        around = links.union(links.select("v", "u"))
    else:
        around = links
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    # Written, so that the join below deals both sides anew and can split a large star.
    least = stored(least.select("u", F.least("u", "m").alias("m")), "star-centres")
    near = around.join(least, "u")
    if large:
        moved = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.where("u > v").distinct()


def _checksum(links: DataFrame) -> tuple:
    row = links.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of the links
    ``src``, ``dst``; repeated links, links in both directions and loops are allowed."""
    current = links.select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    ).where("u > v")
    current = stored(current.distinct(), "links-0")
    before, after = None, _checksum(current)
    number = 0
    while before != after and after[0]:
        number += 1
        current = stored(_star(_star(current, True), False), f"links-{number}")
        before, after = after, _checksum(current)
    ends = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return ends.unionByName(ends.select(F.col("root").alias("node"), "root").distinct())
