"""Row numbers from 0 without a gap, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.session import scratch_path

_RANGE, _START = "__range", "__start"


def numbered(df: DataFrame, column: str, label: str = "numbered") -> tuple[DataFrame, int]:
    """``df`` with its rows numbered in ``column``, in the order of its partitions and of the rows in
    them; and how many there are.

    The rows are written once, so that the numbers stay; they follow from the sizes of the
    partitions, of which one row each reaches the driver.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.withColumn(column, F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    # The upper bits of the id are the partition, the lower ones the place in it.
    part, place = F.shiftright(column, 33), F.col(column).bitwiseAND((1 << 33) - 1)
    sizes = sorted(rows.groupBy(part.alias(_RANGE)).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for number, n in sizes:
        starts.append((number, total))
        total += n
    starts = spark.createDataFrame(starts, f"{_RANGE} bigint, {_START} bigint")
    found = rows.withColumn(_RANGE, part).join(starts, _RANGE)
    return found.withColumn(column, F.col(_START) + place).select(*df.columns, column), total
