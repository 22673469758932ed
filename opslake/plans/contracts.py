"""What a landing dataset looks like and how its rows become silver rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.operators.quality import Expectation, enforce


@dataclass(frozen=True)
class Dataset:
    """One landing dataset.

    ``columns`` maps each silver column to (source column, type), in output order; names in
    ``derived`` are computed from the other silver columns instead.
    """

    name: str
    domain: str
    file_format: str
    landing_ddl: str
    columns: Mapping[str, tuple[str, str] | None]
    expectations: Sequence[Expectation]
    derived: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    shards: int = 1

    @property
    def landing_schema(self) -> StructType:
        return StructType.fromDDL(self.landing_ddl)

    @property
    def key(self) -> str:
        return next(iter(self.columns))

    def project(self, raw: DataFrame) -> DataFrame:
        """Typed, renamed columns. A value that does not fit its type becomes NULL."""
        typed = raw.select(
            *[F.col(spec[0]).try_cast(spec[1]).alias(c) for c, spec in self.columns.items() if spec]
        )
        return typed.select(
            *[self.derived[c]().alias(c) if c in self.derived else F.col(c) for c in self.columns]
        )

    def silver(self, raw: DataFrame) -> DataFrame:
        """Projected rows without those a drop expectation removes."""
        return enforce(self.project(raw), self.expectations)
