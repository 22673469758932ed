"""Sharded landing files of equal size: contiguous key ranges as CSV (with header) or NDJSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.session import discard, shuffles_dropped
from opslake.sources.numbering import numbered
from opslake.sources.schemas import TIMESTAMP_FORMAT

_TIE, _AT = "__tie", "__at"


def write_shards(
    df: DataFrame,
    path: str,
    file_format: str,
    shards: int,
    key: str,
    mode: str = "errorifexists",
    max_records_per_file: int = 0,
) -> None:
    """Write at most ``shards`` files, each with one range of ``key`` in order.

    Every file holds ``ceil(rows / shards)`` rows but the last, which has the rest; with few rows
    there are fewer files. A hash of the row breaks ties, so rows that share a key value spread
    over shards and a lost task writes the same again. Rows are ordered by range and written
    once; their numbers then follow from the counts of the ranges, so no task sees all rows.
    ``max_records_per_file`` splits shards that would get too large for one file. The ordered rows
    and what was shuffled are deleted once the files are written.
    """
    if file_format not in ("csv", "json"):
        raise ValueError(f"unsupported landing format {file_format!r}")
    placed = df.withColumn(_TIE, F.xxhash64(*df.columns))
    ordered = placed.repartitionByRange(key, _TIE).sortWithinPartitions(key, _TIE).drop(_TIE)
    spark = df.sparkSession
    with shuffles_dropped(spark):
        rows, total = numbered(ordered, _AT, "shard-order")
    per_shard = max(1, -(-total // shards))
    shard = F.expr(f"cast({_AT} div {per_shard} as int)")
    cut = rows.withColumn(_TIE, shard).repartitionById(max(1, -(-total // per_shard)), _TIE)
    cut = cut.sortWithinPartitions(_AT).select(*df.columns)

    writer = cut.write.mode(mode).option("timestampFormat", TIMESTAMP_FORMAT)
    writer = writer.option("maxRecordsPerFile", max_records_per_file)
    with shuffles_dropped(spark):
        if file_format == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.json(path)
    discard(rows)
