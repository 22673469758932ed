"""Rescued data: rows are kept whole even where a value does not fit the schema.

A value that cannot be cast, a field the schema does not know and a record that cannot be
parsed end up as JSON text in ``_rescued``; the typed column is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

RESCUED = "_rescued"
SOURCE_FILE = "_source_file"
CORRUPT = "_corrupt_record"


def all_strings(schema: StructType, corrupt: bool = False) -> StructType:
    """The same columns as text, optionally with the column for unparseable records."""
    fields = [StructField(f.name, StringType()) for f in schema.fields]
    return StructType(fields + ([StructField(CORRUPT, StringType())] if corrupt else []))


def bronze_schema(schema: StructType) -> StructType:
    """The dataset's columns plus rescued data and source file."""
    return StructType(list(schema.fields)).add(RESCUED, "string").add(SOURCE_FILE, "string")


def _rescue_json(misfits: Mapping[str, Column], unknown: Column | None, corrupt: Column) -> Column:
    """JSON object of the misfit values, or NULL. Built only for rows that need it."""
    pairs = F.array(
        *[F.struct(F.lit(n).alias("k"), v.alias("v")) for n, v in misfits.items()],
        F.struct(F.lit(CORRUPT).alias("k"), corrupt.alias("v")),
    )
    known = F.map_from_entries(F.filter(pairs, lambda p: p["v"].isNotNull()))
    merged = known if unknown is None else F.map_concat(known, unknown)
    needed = corrupt.isNotNull()
    for value in misfits.values():
        needed = needed | value.isNotNull()
    if unknown is not None:
        needed = needed | (F.size(unknown) > 0)
    return F.when(needed, F.to_json(merged))


def fit(
    df: DataFrame,
    raw: Mapping[str, Column],
    schema: StructType,
    unknown: Column | None,
    corrupt: Column,
    keep: list[str],
) -> DataFrame:
    """Typed columns from their text; what doesn't fit, is ``unknown`` or ``corrupt`` is rescued."""
    cast = {f.name: raw[f.name].try_cast(f.dataType) for f in schema.fields}
    misfits = {
        f.name: F.when(cast[f.name].isNull(), raw[f.name])
        for f in schema.fields
        if not isinstance(f.dataType, StringType)
    }
    return df.select(
        *[c.alias(n) for n, c in cast.items()],
        _rescue_json(misfits, unknown, corrupt).alias(RESCUED),
        *keep,
    )


def rescue_text_columns(df: DataFrame, schema: StructType, extra: list[str] | None = None) -> DataFrame:
    """Typed columns from text columns (CSV cells). ``extra`` columns go to ``_rescued``."""
    keep = [SOURCE_FILE] if SOURCE_FILE in df.columns else []
    corrupt = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string")
    raw = {
        f.name: F.col(f.name) if f.name in df.columns else F.lit(None).cast("string")
        for f in schema.fields
    }
    unknown = None
    if extra:
        cells = F.array(*[F.struct(F.lit(n).alias("k"), F.col(n).alias("v")) for n in extra])
        unknown = F.map_from_entries(F.filter(cells, lambda p: p["v"].isNotNull()))
    return fit(df, raw, schema, unknown, corrupt, keep)


def rescue_fields(df: DataFrame, schema: StructType, fields: str) -> DataFrame:
    """Typed columns from a map of text by name. Names that the schema lacks go to ``_rescued``, as
    does the entry for a record that can't be parsed."""
    keep = [SOURCE_FILE] if SOURCE_FILE in df.columns else []
    known = [f.name for f in schema.fields]
    raw = {n: F.try_element_at(F.col(fields), F.lit(n)) for n in known}
    unknown = F.map_filter(
        F.coalesce(F.col(fields), F.create_map().cast("map<string,string>")),
        lambda k, v: ~k.isin([*known, CORRUPT]) & v.isNotNull(),
    )
    corrupt = F.try_element_at(F.col(fields), F.lit(CORRUPT))
    return fit(df, raw, schema, unknown, corrupt, keep)


def rescue_json_lines(df: DataFrame, schema: StructType, column: str = "value") -> DataFrame:
    """Typed columns from lines of JSON text. Each line is parsed once, into a map of text."""
    whole = F.create_map(F.lit(CORRUPT), F.col(column))
    parsed = df.filter(F.length(F.trim(column)) > 0).withColumn(
        "__fields", F.coalesce(F.from_json(column, "map<string,string>"), whole)
    )
    return rescue_fields(parsed, schema, "__fields")
