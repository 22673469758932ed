"""Metric views: named dimensions and measures aggregated at the grain a reader asks for.

A view can be published as a table of states at its finest grain, from which plain SQL rolls up
to any coarser one: sums and counts add up, a mean is a sum and a count, and a distinct count is
bitmaps of the counted ids, one per range of ids, which merge by OR.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.sources.catalog import materialize, publish_view

BUCKET = "distinct_bucket"
_MEASURE = re.compile(r"^(SUM|AVG|COUNT)\((DISTINCT )?(.*)\)$", re.S)


def sort_column(spec: str) -> Column:
    """``"name"`` ascending or ``"-name"`` descending; NULLs come last either way."""
    if spec.startswith("-"):
        return F.col(spec[1:]).desc_nulls_last()
    return F.col(spec).asc_nulls_last()


@dataclass(frozen=True)
class MetricView:
    """``source`` is a table name; expressions are SQL over that table's columns."""

    name: str
    source: str
    dimensions: Mapping[str, str]
    measures: Mapping[str, str]
    tags: Mapping[str, str] = field(default_factory=dict)

    def _pick(self, kind: str, known: Mapping[str, str], wanted: Sequence[str]) -> list[Column]:
        unknown = [n for n in wanted if n not in known]
        if unknown:
            raise KeyError(f"{self.name} has no {kind} {unknown}; it has {sorted(known)}")
        return [F.expr(known[n]).alias(n) for n in wanted]

    def query(
        self,
        source: DataFrame | SparkSession,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: str | None = None,
        order_by: Sequence[str] = (),
        limit: int | None = None,
    ) -> DataFrame:
        """Aggregate ``measures`` (all by default) by ``dimensions``; none gives one total row.

        ``source`` is a session, to read the view's own table, or a frame that stands in
        for it. ``where`` filters source rows. ``limit`` after ``order_by`` is a top-k.
        """
        if isinstance(source, SparkSession):
            source = source.table(self.source)
        dims = self._pick("dimension", self.dimensions, dimensions)
        aggs = self._pick("measure", self.measures, list(self.measures) if measures is None else measures)
        if not aggs:
            raise ValueError("ask for at least one measure")
        if where:
            source = source.filter(where)
        result = source.groupBy(*dims).agg(*aggs) if dims else source.agg(*aggs)
        if order_by:
            result = result.orderBy(*[sort_column(o) for o in order_by])
        return result if limit is None else result.limit(limit)

    def _distinct(self) -> str | None:
        """The expression whose distinct values are counted; a view has one at most."""
        found = {m[3] for e in self.measures.values() if (m := _MEASURE.match(e)) and m[2]}
        if len(found) > 1:
            raise ValueError(f"{self.name} counts distinct values of {sorted(found)}; one is possible")
        return found.pop() if found else None

    def _parts(self, measure: str) -> tuple[str, str, str]:
        """(function, DISTINCT or nothing, argument) of a measure that can be rolled up."""
        match = _MEASURE.match(self.measures[measure])
        if match is None or match[2] and match[1] != "COUNT":
            raise ValueError(f"{self.measures[measure]} can't be rolled up")
        return match[1], match[2] or "", match[3]

    def states(self, source: DataFrame) -> DataFrame:
        """The additive states of all measures at the finest grain (and, with a distinct count,
        per range of its ids): ``<measure>`` or ``<measure>_sum`` and ``<measure>_n``, and bitmaps."""
        distinct = self._distinct()
        grain = {n: F.expr(e) for n, e in self.dimensions.items()}
        if distinct:
            grain[BUCKET] = F.expr(f"bitmap_bucket_number({distinct})")
        aggs = []
        for name in self.measures:
            function, only, value = self._parts(name)
            if only:
                aggs.append(F.expr(f"bitmap_construct_agg(bitmap_bit_position({value}))").alias(name))
            elif function == "AVG":
                aggs += [F.expr(f"SUM({value})").alias(f"{name}_sum"), F.expr(f"COUNT({value})").alias(f"{name}_n")]
            else:
                aggs.append(F.expr(self.measures[name]).alias(name))
        return source.groupBy(*(c.alias(n) for n, c in grain.items())).agg(*aggs)

    def rollup_sql(
        self,
        states: str,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: str | None = None,
    ) -> str:
        """SQL over a table of states for any grain. ``where`` filters by dimensions."""
        measures = list(self.measures) if measures is None else list(measures)
        self._pick("dimension", self.dimensions, dimensions)
        self._pick("measure", self.measures, measures)
        by_range, final = [], []
        for name in measures:
            function, only, _ = self._parts(name)
            if only:
                by_range.append(f"bitmap_count(bitmap_or_agg({name})) AS {name}")
                final.append(f"coalesce(SUM({name}), 0) AS {name}")
            elif function == "AVG":
                by_range += [f"SUM({name}_sum) AS {name}_sum", f"SUM({name}_n) AS {name}_n"]
                final.append(f"SUM({name}_sum) / nullif(SUM({name}_n), 0) AS {name}")
            else:
                by_range.append(f"SUM({name}) AS {name}")
                total = f"SUM({name})"
                final.append(f"{f'coalesce({total}, 0)' if function == 'COUNT' else total} AS {name}")
        kept = f" WHERE {where}" if where else ""
        table = f"{states}{kept}"
        if any(self._parts(m)[1] for m in measures):
            # The bitmaps of a range of ids are merged first; ranges then add up.
            inner = ", ".join([*dimensions, BUCKET])
            table = f"(SELECT {', '.join([inner, *by_range])} FROM {table} GROUP BY {inner})"
        grain = f" GROUP BY {', '.join(dimensions)}" if dimensions else ""
        return f"SELECT {', '.join([*dimensions, *final])} FROM {table}{grain}"

    def publish(self, spark: SparkSession, schema: str, root: str, source: DataFrame | None = None) -> str:
        """Store the states as ``<schema>.<name>_states`` under ``root`` and publish a catalog view
        ``<schema>.<name>`` at the finest grain, rolled up from them, with tags and measures among its
        properties. Returns the view's name; ``rollup`` asks for other grains."""
        target = f"{schema}.{self.name}"
        source = spark.table(self.source) if source is None else source
        states = self.states(source)
        materialize(states, f"{target}_states", root, f"States of {self.name}")
        measures = {f"measure.{n}": e for n, e in self.measures.items()}
        query = self.rollup_sql(f"{target}_states", list(self.dimensions))
        publish_view(spark, target, query, "", {**self.tags, **measures})
        return target

    def rollup(
        self,
        spark: SparkSession,
        schema: str,
        dimensions: Sequence[str] = (),
        measures: Sequence[str] | None = None,
        where: str | None = None,
    ) -> DataFrame:
        """The measures at any grain, from the published states."""
        return spark.sql(self.rollup_sql(f"{schema}.{self.name}_states", dimensions, measures, where))
