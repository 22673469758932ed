"""Schema inference, evolution and the versioned schema registry."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


# Types from the narrowest to the widest; a column has the first that all its values fit.
_LATTICE = ("int", "bigint", "double", "timestamp", "boolean")


_BIT = {kind: 1 << at for at, kind in enumerate(_LATTICE)}


def _fits(cell: Column) -> Column:
    """The types that a cell's text fits, as bits; NULL for an empty or NULL cell. What is cheap to
    tell comes first, and a cell is cast only to what it looks like."""

    def bits(*kinds: str) -> Column:
        return F.lit(sum(_BIT[k] for k in kinds))

    def casts(kind: str) -> Column:
        return cell.try_cast(kind).isNotNull()

    number = F.when(casts("double"), bits("double")).otherwise(bits())
    whole = F.when(casts("int"), bits("int", "bigint", "double")).when(casts("bigint"), bits("bigint", "double"))
    # Not every text that can be cast is meant as a time: "2024" is a number.
    dated = F.when(casts("timestamp"), bits("timestamp")).otherwise(bits())
    return F.when(
        F.trim(cell) != "",
        F.when(cell.rlike(r"^\s*[+-]?\d+\s*$"), whole.otherwise(number))
        .when(cell.rlike(r"^\s*\d{4}-\d{2}-\d{2}([ T].*)?$"), dated)
        .when(cell.rlike(r"^\s*[+-]?(\d|\.\d|NaN$|Inf)"), number)
        .when(F.lower(F.trim(cell)).isin("true", "false"), bits("boolean"))
        .otherwise(bits()),
    )


def _narrowest(bits: int | None) -> DataType:
    """The first type that all cells fit; text if there is none, or if every cell is empty."""
    kinds = (kind for kind in _LATTICE if bits and bits & _BIT[kind])
    return DataType.fromDDL(next(kinds, "string"))


def infer_fields(entries: DataFrame, limit: int | None = None) -> StructType:
    """The columns among (``name``, ``value``) entries, by name, typed by one aggregate that
    combines before it shuffles. No columns at all if there are more than ``limit``."""
    # Typed before they are grouped: within the aggregate, every use of the cell's bits would
    # repeat all of it, in a method too long for the JVM to compile.
    typed = entries.select("name", _fits(F.col("value")).alias("bits"))
    found = typed.groupBy("name").agg(F.bit_and("bits").alias("bits"))
    rows = (found if limit is None else found.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        return StructType()
    schema = StructType()
    for name, bits in sorted(rows, key=lambda row: row["name"]):
        schema = schema.add(name, _narrowest(bits))
    return schema


def infer_schema(
    spark: SparkSession,
    path: str,
    file_format: str,
    modified_after: str | None = None,
) -> StructType:
    """Column types of the CSV (with header) or NDJSON files under ``path``, from one scan.

    CSV cells are read as text and typed by an aggregate by column; all files must share one
    header. JSON lines are typed through their variant schema: whole numbers are bigint, other
    numbers double, all else is text. On large datasets run it on the files of one delivery
    (``modified_after``): the ingest rescues whatever the inferred types do not fit.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    if file_format == "csv":
        cells = reader.option("header", True).csv(path)
        # A row per cell: what is compiled doesn't grow with the number of columns.
        columns = [F.col(f"`{c}`") for c in cells.columns]
        entries = cells.unpivot([], columns, "name", "value")
        found = {f.name: f.dataType for f in infer_fields(entries).fields}
        schema = StructType()
        for name in cells.columns:
            schema = schema.add(name, found.get(name, _narrowest(None)))
        return schema
    if file_format == "json":
        return infer_json_fields(reader.text(path), "value")
    raise ValueError(f"unsupported landing format {file_format!r}")


def infer_json_fields(lines: DataFrame, column: str) -> StructType:
    """The fields of lines of JSON text, from one aggregate over their variant schemas."""
    variant = F.schema_of_variant_agg(F.try_parse_json(column))
    found = lines.where(F.length(F.trim(column)) > 0).agg(variant.alias("found")).head()["found"]
    schema = StructType()
    if not found.startswith("OBJECT<"):
        return schema
    for name, kind in _object_fields(found.removeprefix("OBJECT<").removesuffix(">")):
        whole = kind == "BIGINT" or kind.startswith("DECIMAL") and kind.endswith(",0)")
        number = kind in ("DOUBLE", "FLOAT") or kind.startswith("DECIMAL")
        plain = "boolean" if kind == "BOOLEAN" else "string"
        kind = "bigint" if whole else "double" if number else plain
        schema = schema.add(name, DataType.fromDDL(kind))
    return schema


def _object_fields(text: str) -> list[tuple[str, str]]:
    """(name, type) of the fields in an object type's text; names may be in backquotes."""
    fields, depth, quoted, start = [], 0, False, 0
    for at, c in enumerate(text + ","):
        if c == "`":
            quoted = not quoted
        elif not quoted:
            depth += (c in "<(") - (c in ">)")
            if c == "," and depth == 0:
                field, start = text[start:at].strip(), at + 1
                cut = field.rindex("`: ") + 1 if field.startswith("`") else field.find(": ")
                name = field[:cut]
                if field.startswith("`"):
                    name = name[1:-1].replace("``", "`")
                if field:
                    fields.append((name, field[cut + 2 :]))
    return fields


def evolve(old: StructType | None, new: StructType) -> StructType:
    """``old`` followed by the columns only ``new`` has; known columns keep their types."""
    if old is None:
        return new
    known = {f.name for f in old.fields}
    added = [StructField(f.name, f.dataType, True) for f in new.fields if f.name not in known]
    return StructType(list(old.fields) + added)


@dataclass(frozen=True)
class RegisteredSchema:
    dataset: str
    version: int
    generation: int
    schema: StructType


class SchemaRegistry:
    """Schema versions per dataset, kept as a small parquet table on shared storage.

    ``generation`` counts full refreshes: it names the output and checkpoint folders in use.
    """

    _DDL = "dataset string, version int, generation int, schema_json string"

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._created = False

    def _versions(self, dataset: str) -> DataFrame:
        # A dataset has a handful of rows, one per schema change or refresh.
        if not self._created:
            self.spark.createDataFrame([], self._DDL).write.mode("ignore").parquet(self.path)
            self._created = True
        return (
            self.spark.read.schema(self._DDL).parquet(self.path).filter(F.col("dataset") == dataset)
        )

    def load(self, dataset: str, version: int | None = None) -> RegisteredSchema | None:
        """The given version, or the latest one; None when there is none."""
        rows = self._versions(dataset)
        if version is not None:
            rows = rows.filter(F.col("version") == version)
        found = rows.orderBy(F.desc("version")).head(1)
        if not found:
            return None
        row = found[0]
        fields = StructType.fromJson(json.loads(row["schema_json"]))
        return RegisteredSchema(dataset, row["version"], row["generation"], fields)

    def save(
        self, dataset: str, schema: StructType, generation: int | None = None
    ) -> RegisteredSchema:
        """Register a schema; a new version only when schema or generation changed."""
        current = self.load(dataset)
        generation = generation if generation is not None else (current.generation if current else 0)
        if current and current.schema == schema and current.generation == generation:
            return current
        version = current.version + 1 if current else 1
        row = (dataset, version, generation, schema.json())
        self.spark.createDataFrame([row], self._DDL).coalesce(1).write.mode("append").parquet(
            self.path
        )
        return RegisteredSchema(dataset, version, generation, schema)

    def evolve(self, dataset: str, seen: StructType) -> RegisteredSchema:
        """Add the new columns of ``seen`` to the registered schema."""
        current = self.load(dataset)
        return self.save(dataset, evolve(current.schema if current else None, seen))
