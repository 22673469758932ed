"""Keyed tables kept as a base and small segments of changes, merged when they are read.

A segment is a folder of parquet files under ``data``: rows to put in place of those of their
key, and markers for keys that are gone. A manifest, a row per version, names the segments in
force; it is written after the segment, so a run that dies in between changes nothing, and the next
one writes that segment number again. One writer at a time; readers are never in the way.

Writing n changes writes n rows. Reading joins the base with the keys of the segments, which
are few until ``compact`` folds them into a new base. Old segments and manifests stay on disk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DELETED = "_deleted"
SEGMENT = "segment"
_MANIFEST = "version int, base int, last int"


class SegmentedTable:
    """The table under ``path``, one row per ``key``."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        self.manifest_path = f"{self.path}/manifest"

    def manifest(self) -> tuple[int, int, int] | None:
        """(version, base segment, last segment) in force; None before the first write."""
        empty = self.spark.createDataFrame([], _MANIFEST)
        empty.write.mode("ignore").parquet(self.manifest_path)
        rows = self.spark.read.schema(_MANIFEST).parquet(self.manifest_path)
        newest = rows.orderBy(F.desc("version")).head(1)
        return tuple(newest[0]) if newest else None

    def _folder(self, number: int) -> str:
        return f"{self.path}/data/{SEGMENT}-{number:06d}"

    def _commit(self, version: int, base: int, last: int) -> None:
        row = self.spark.createDataFrame([(version, base, last)], _MANIFEST)
        row.coalesce(1).write.mode("append").parquet(self.manifest_path)

    def _rows(self, df: DataFrame) -> DataFrame:
        return df.where(F.col(self.key).isNotNull()).withColumn(DELETED, F.lit(False))

    def rewrite(self, rows: DataFrame) -> None:
        """Make ``rows``, one per key, the new base. Rows without a key are left out."""
        version, _, last = self.manifest() or (0, 0, -1)
        self._rows(rows).write.mode("overwrite").parquet(self._folder(last + 1))
        self._commit(version + 1, last + 1, last + 1)

    def append(self, upserts: DataFrame, deleted: DataFrame) -> None:
        """Add a segment: the rows of ``upserts`` instead of what their keys had, and nothing any
        more for the keys of ``deleted``. No key may be in both; the base isn't touched."""
        found = self.manifest()
        if found is None:
            raise ValueError("write a base first")
        version, base, last = found
        gone = deleted.select(self.key).withColumn(DELETED, F.lit(True))
        rows = self._rows(upserts).unionByName(gone, allowMissingColumns=True)
        rows.write.mode("overwrite").parquet(self._folder(last + 1))
        self._commit(version + 1, base, last + 1)

    def segment(self, number: int) -> DataFrame:
        return self.spark.read.parquet(self._folder(number))

    def schema(self) -> StructType:
        _, base, _ = self.manifest()
        fields = self.segment(base).schema.fields
        return StructType([f for f in fields if f.name != DELETED])

    def sql(self, columns: Sequence[str] | None = None, numbered: bool = False) -> str:
        """A query for the merged rows, for a catalog view too. ``numbered`` adds ``segment``, the
        one that holds the row."""
        _, base, last = self.manifest()
        names = list(columns) if columns is not None else self.schema().names
        quoted = [f"`{c}`" for c in dict.fromkeys([self.key, *names])]

        def rows(number: int, extra: str = "") -> str:
            folder = self._folder(number).replace("`", "``")
            return f"SELECT {', '.join(quoted)}, {number} AS {SEGMENT}{extra} FROM parquet.`{folder}`"

        shown = ", ".join([f"`{c}`" for c in names] + [SEGMENT] * numbered)
        if base == last:
            return f"SELECT {shown} FROM ({rows(base)})"
        changes = " UNION ALL ".join(rows(n, f", {DELETED}") for n in range(base + 1, last + 1))
        row = ", ".join([*quoted, SEGMENT, DELETED])
        return (
            f"WITH changes AS (SELECT `{self.key}` AS changed, max_by(struct({row}), {SEGMENT}) AS newest "
            f"FROM ({changes}) GROUP BY `{self.key}`) "
            f"SELECT {shown} FROM (SELECT b.* FROM ({rows(base)}) b LEFT ANTI JOIN changes c "
            f"ON b.`{self.key}` = c.changed UNION ALL "
            f"SELECT {', '.join(f'newest.{c}' for c in [*quoted, SEGMENT])} FROM changes "
            f"WHERE NOT newest.{DELETED})"
        )

    def read(self, columns: Sequence[str] | None = None, numbered: bool = False) -> DataFrame:
        """The merged rows; only the columns asked for are read."""
        return self.spark.sql(self.sql(columns, numbered))

    def compact(self) -> None:
        """Fold the segments into a new base."""
        _, base, last = self.manifest()
        if base != last:
            self.rewrite(self.read())
