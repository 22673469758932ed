"""Streaming tables: files in, append-only parquet out, each input once per checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.sources.rescue import (
    CORRUPT,
    SOURCE_FILE,
    all_strings,
    bronze_schema,
    rescue_json_lines,
    rescue_text_columns,
)


def ingest_stream(
    spark: SparkSession,
    path: str,
    file_format: str,
    schema: StructType,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """Streaming bronze rows of a landing folder.

    Cells are read as text and cast afterwards, so a bad value costs that value and not the
    row. A CSV file whose header differs from ``schema`` stops the stream rather than
    swapping values: ``streaming.deliveries`` takes such files.
    ``max_bytes_per_trigger`` (a number of bytes) bounds one micro-batch on a large backlog.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if file_format == "csv":
        cells = (
            reader.schema(all_strings(schema, corrupt=True))
            .option("header", True)
            .option("enforceSchema", False)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path)
            .withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        )
        return rescue_text_columns(cells, schema)
    if file_format == "json":
        lines = reader.text(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
        return rescue_json_lines(lines, schema)
    raise ValueError(f"unsupported landing format {file_format!r}")


def stream_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A streaming table's rows as a stream: each is delivered once per checkpoint."""
    return spark.readStream.schema(schema).parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A streaming table's committed rows; columns added later are NULL in older files."""
    return spark.read.schema(schema).parquet(path)


def write_stream(df: DataFrame, path: str, checkpoint: str) -> list[dict]:
    """Append everything available and stop.

    Returns the observed counts of the micro-batches whose progress the session still holds,
    one dict per batch; ``streaming.deliveries.load_silver`` keeps the counts of all.
    """
    query = (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return [row.asDict() for p in query.recentProgress for row in p.observedMetrics.values()]
