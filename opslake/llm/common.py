"""Helpers shared by the text operators: normalisation, row ids, tables in the shared folder."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.session import discard as discard
from opslake.session import scratch_path

ROW = "__row"
SPLITS = "spark.sql.files.minPartitionNum"
UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null stays null.

    ``lower`` does the same, faster, where every character is one byte.
    """
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def with_row(df: DataFrame) -> DataFrame:
    """``df`` with a row id in ``__row``.

    The id follows from the place of the row in its partition, so two uses agree as long as
    ``df`` reads stored tables that are split alike. How files are split depends on the cores
    at hand, which change when executors come or go; so the number that Spark splits by is
    held for the session, unless it is set already.
    """
    spark = df.sparkSession
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(spark.sparkContext.defaultParallelism))
    return df.withColumn(ROW, F.monotonically_increasing_id())


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, and a lost
    executor costs no recomputation of what went before."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(
    df: DataFrame, key: str, label: str, buckets: int | None = None, compression: str = "snappy"
) -> DataFrame:
    """Like ``stored``, in buckets of ``key``, as many as a shuffle has partitions unless said:
    what groups by the key reads the buckets and needs no shuffle."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = f"{label}_{path[-32:]}"
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, key).option("path", path).option("compression", compression)
    writer.saveAsTable(name)
    table = spark.table(name)
    table.schema  # resolved; the name is needed no longer, and the files stay
    spark.sql(f"drop table {name}")
    return table


def map_arrow(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` under a shorter name, for plans that read as one chain."""
    return df.mapInArrow(fn, schema)


def number_sorted(df: DataFrame, label: str, *keys: str) -> DataFrame:
    """The distinct keys with an integer ``name`` each, in the order of the keys.

    Keys are combined before they are shuffled, dealt out by range and sorted; the number
    is the place in that order. The numbers are fixed by writing them.
    """
    ordered = df.select(*keys).distinct().repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(ordered.withColumn("name", F.monotonically_increasing_id()), label)
