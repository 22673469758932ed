"""Landing files to bronze in micro-batches that place cells by name and learn new columns.

Each batch reads its own files only, as lines. A CSV file's header is its line of the lowest
position; files of one batch may have their columns in any order. Headers are found once and
written, one row per file; the lines themselves are neither shuffled nor kept. Columns that the registered
schema lacks are typed by the batch's own values and join the schema; a name that a header
repeats keeps its first column, and the others go to ``_rescued``. A batch writes a folder of its
own and a replayed batch writes it again, so a file counts once even after a crash.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Callable, Collection, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.operators.quality import (
    EVENT_LOG_SCHEMA,
    Expectation,
    apply_expectations,
    event_log_rows,
)
from opslake.session import scratch_path
from opslake.sources.rescue import CORRUPT, SOURCE_FILE, bronze_schema, fit, rescue_fields
from opslake.sources.schemas import (
    RegisteredSchema,
    SchemaRegistry,
    infer_fields,
    infer_json_fields,
)

LINE, AT, FIELDS = "value", "__at", "__fields"
HEADER, _CELLS = "__header", "__cells"
# A batch that brings more new names than this is no table that grew: they stay in ``_rescued``.
MAX_NEW_COLUMNS = 1000


def batch_folder(root: str, batch: int) -> str:
    return f"{root}/batch-{batch:08d}"


def _with_folder(spark: SparkSession, root: str, schema: StructType | str) -> None:
    """Make sure the folder exists, so that it can be read before its first batch."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(f"{root}/empty")


def run_batches(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None]) -> None:
    """Hand everything available to ``step``, batch by batch, and stop. A batch whose step didn't
    end comes again under its number."""
    query = (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_batches(spark: SparkSession, root: str, schema: StructType) -> DataFrame:
    """The rows of all batch folders; columns added later are NULL in older ones."""
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(root)


def _stream(spark: SparkSession, max_bytes_per_trigger: str | None):
    reader = spark.readStream.option("recursiveFileLookup", True)
    return reader.option("maxBytesPerTrigger", max_bytes_per_trigger) if max_bytes_per_trigger else reader


def stream_batches(
    spark: SparkSession, root: str, schema: StructType, max_bytes_per_trigger: str | None = None
) -> DataFrame:
    """The rows of the batch folders as a stream: each is delivered once per checkpoint."""
    return _stream(spark, max_bytes_per_trigger).schema(schema).parquet(root)


def delivered_lines(
    spark: SparkSession, landing: str, max_bytes_per_trigger: str | None = None
) -> DataFrame:
    """The lines of the landing files as a stream, with file and position: positions rise
    within a file's first split."""
    return _stream(spark, max_bytes_per_trigger).text(landing).select(
        LINE,
        F.col("_metadata.file_path").alias(SOURCE_FILE),
        (F.col("_metadata.file_block_start") == 0).alias("__first_split"),
    )


def header_names(line: str) -> list[str]:
    """Column names of a header line. A name that comes again, or is empty, gets its place in
    the line added, under which its cells are rescued."""
    names: list[str] = []
    for at, name in enumerate(next(csv.reader([line.lstrip("\ufeff")])), 1):
        name = name.strip()
        names.append(f"{name}#{at}" if not name or name in names else name)
    return names


def _csv_headers(lines: DataFrame) -> DataFrame:
    """The header line of every file that has one."""
    spark = lines.sparkSession
    placed = _filled(lines).withColumn(AT, F.monotonically_increasing_id())
    first = F.min(F.struct(F.col(AT).alias("at"), F.col(LINE).alias("line")))
    found = placed.where("__first_split").groupBy(SOURCE_FILE).agg(first.alias("first"))
    found = found.select(SOURCE_FILE, F.col("first.line").alias(HEADER))
    path = scratch_path(spark, "headers")
    found.write.parquet(path)
    return spark.read.schema(found.schema).parquet(path)


def _filled(lines: DataFrame) -> DataFrame:
    return lines.where(F.length(F.trim(LINE)) > 0)


class _CsvRows:
    """The data lines of a batch, cut into cells that are found by their header's names."""

    def __init__(self, lines: DataFrame) -> None:
        headers = _csv_headers(lines)
        # One row per different header reaches the driver, not one per file.
        self.names = {r[0]: header_names(r[0]) for r in sorted(headers.select(HEADER).distinct().collect())}
        joined = _filled(lines).join(headers, SOURCE_FILE).select(SOURCE_FILE, LINE, HEADER)
        same = F.col(LINE) == F.col(HEADER)
        # Of the lines that equal their file's header one is the header, whichever it is; the others
        # are data.
        more = joined.where(same).groupBy(SOURCE_FILE, LINE, HEADER).agg(F.count(F.lit(1)).alias("n"))
        more = more.where("n > 1").select(SOURCE_FILE, LINE, HEADER, F.explode(F.sequence(F.lit(2), "n")))
        self.lines = joined.where(~same).unionByName(more.select(SOURCE_FILE, LINE, HEADER))

    def with_names(self, wanted: Collection[str]) -> DataFrame:
        """Entries (``name``, ``value``) of the cells under these names."""
        found = {line: [n for n in names if n in wanted] for line, names in self.names.items()}
        found = {line: names for line, names in found.items() if names}
        cut = self._cut(self.lines.where(F.col(HEADER).isin(sorted(found))), found)
        entries = F.array(
            *(
                F.struct(F.lit(n).alias("name"), self._cell(n).alias("value"), self._has(n).alias("has"))
                for n in sorted(wanted)
            )
        )
        return cut.select(F.explode(entries).alias("entry")).where("entry.has").select("entry.name", "entry.value")

    def typed(self, schema: StructType) -> DataFrame:
        """Typed columns; cells under names that the schema lacks are rescued."""
        cut = self._cut(self.lines, self.names)
        unknown = None
        for line, names in self.names.items():
            strange = [n for n in names if n not in schema.names]
            if strange:
                cells = F.map_from_arrays(
                    F.array(*(F.lit(n) for n in strange)), F.array(*(self._of(line, n) for n in strange))
                )
                unknown = _when(unknown, F.col(HEADER) == line, F.map_filter(cells, lambda _, v: v.isNotNull()))
        if unknown is not None:
            unknown = F.coalesce(unknown, F.create_map().cast("map<string,string>"))
        bad = [F.col(f"{_CELLS}{width}")[CORRUPT] for width in self._widths(self.names)]
        corrupt = F.coalesce(*bad, F.lit(None).cast("string"))
        raw = {n: self._cell(n) for n in schema.names}
        return fit(cut, raw, schema, unknown, corrupt, [SOURCE_FILE])

    @staticmethod
    def _widths(names: Mapping[str, list[str]]) -> list[int]:
        return sorted({len(found) for found in names.values()})

    def _cut(self, lines: DataFrame, headers: Iterable[str]) -> DataFrame:
        """A struct of cells per different number of columns; each line fills the one of its header."""
        parts = {}
        for width in self._widths({line: self.names[line] for line in headers}):
            layout = ", ".join(f"c{at} string" for at in range(width)) + f", {CORRUPT} string"
            own = [line for line, names in self.names.items() if len(names) == width]
            cells = F.from_csv(LINE, layout, {"columnNameOfCorruptRecord": CORRUPT})
            parts[f"{_CELLS}{width}"] = F.when(F.col(HEADER).isin(own), cells)
        return lines.withColumns(parts)

    def _of(self, line: str, name: str) -> Column:
        names = self.names[line]
        return F.col(f"{_CELLS}{len(names)}")[f"c{names.index(name)}"]

    def _having(self, name: str) -> dict[tuple[int, int], list[str]]:
        """The headers that have a name, by their number of columns and its place."""
        found: dict[tuple[int, int], list[str]] = {}
        for line, names in self.names.items():
            if name in names:
                found.setdefault((len(names), names.index(name)), []).append(line)
        return found

    def _has(self, name: str) -> Column:
        return F.col(HEADER).isin([line for own in self._having(name).values() for line in own])

    def _cell(self, name: str) -> Column:
        cell = None
        for (width, at), own in self._having(name).items():
            cell = _when(cell, F.col(HEADER).isin(own), F.col(f"{_CELLS}{width}")[f"c{at}"])
        return F.lit(None).cast("string") if cell is None else cell


def _when(found: Column | None, condition: Column, value: Column) -> Column:
    return F.when(condition, value) if found is None else found.when(condition, value)


def _json_lines(lines: DataFrame) -> DataFrame:
    """The lines of a batch as maps of their fields; one that can't be parsed is kept whole."""
    parsed = F.from_json(LINE, "map<string,string>")
    whole = F.create_map(F.lit(CORRUPT), F.col(LINE))
    rows = lines.where(F.length(F.trim(LINE)) > 0)
    return rows.select(SOURCE_FILE, F.coalesce(parsed, whole).alias(FIELDS))


def _learn_csv(rows: _CsvRows, known: StructType) -> StructType:
    """The columns that these rows have and ``known`` lacks, typed by their cells. Names that
    stand for a repeated or an unnamed column are no columns. Rows are read only if a header has
    such a name."""
    names = {n for found in rows.names.values() for n in found}
    fresh = {n for n in names.difference([*known.names, CORRUPT]) if not re.search(r"#\d+$", n)}
    if not fresh:
        return StructType()
    return infer_fields(rows.with_names(fresh), limit=MAX_NEW_COLUMNS)


def _learn_json(lines: DataFrame, known: StructType) -> StructType:
    """The fields that these lines have and ``known`` lacks."""
    fresh = [f for f in infer_json_fields(lines, LINE).fields if f.name not in known.names]
    return StructType(fresh if len(fresh) <= MAX_NEW_COLUMNS else [])


def load_bronze(
    spark: SparkSession,
    dataset: str,
    file_format: str,
    landing: str,
    bronze: str,
    checkpoint: str,
    registry: SchemaRegistry,
    max_bytes_per_trigger: str | None = None,
) -> RegisteredSchema:
    """Bring the bronze folder up to date with the landing files; returns the schema, which may
    have grown. The dataset must be registered."""
    if file_format not in ("csv", "json"):
        raise ValueError(f"unsupported landing format {file_format!r}")

    def step(batch: DataFrame, number: int) -> None:
        known = registry.load(dataset).schema
        if file_format == "csv":
            rows = _CsvRows(batch)
            known = registry.evolve(dataset, _learn_csv(rows, known)).schema
            typed = rows.typed(known)
        else:
            known = registry.evolve(dataset, _learn_json(batch, known)).schema
            typed = rescue_fields(_json_lines(batch), known, FIELDS)
        typed.select(*bronze_schema(known).names).write.mode("overwrite").parquet(batch_folder(bronze, number))

    _with_folder(spark, bronze, bronze_schema(registry.load(dataset).schema))
    run_batches(delivered_lines(spark, landing, max_bytes_per_trigger), checkpoint, step)
    return registry.load(dataset)


def load_silver(
    rows: DataFrame,
    project: Callable[[DataFrame], DataFrame],
    expectations: Sequence[Expectation],
    silver: str,
    checkpoint: str,
    log: str,
    dataset: str,
    run_id: str = "",
) -> None:
    """Bring the silver folder up to date with a stream of bronze rows.

    The expectations are counted in the pass that writes a batch, and the counts are written under
    the batch's number: a batch that comes again replaces its rows and its counts, so the log
    counts every row once and no older row is read.
    """
    spark = rows.sparkSession

    def step(batch: DataFrame, number: int) -> None:
        counts = Observation()
        kept = apply_expectations(project(batch), expectations, counts)
        kept.write.mode("overwrite").parquet(batch_folder(silver, number))
        entries = event_log_rows(spark, run_id, dataset, expectations, [counts.get])
        entries.coalesce(1).write.mode("overwrite").parquet(batch_folder(log, number))

    _with_folder(spark, silver, project(rows).schema)
    _with_folder(spark, log, EVENT_LOG_SCHEMA)
    run_batches(rows, checkpoint, step)
