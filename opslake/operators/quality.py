"""Data-quality expectations: warn, drop or fail, with counted results.

Predicates are SQL over the projected columns. A NULL predicate counts as failed. All
expectations of a table are counted on the rows before any drop, in the same pass that
writes them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")
EVENT_LOG_SCHEMA = (
    "run_id string, dataset string, expectation string, action string, passed bigint, failed bigint"
)
ROWS_METRIC = "rows"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self) -> None:
        if self.action not in ACTIONS:
            raise ValueError(f"unknown action {self.action!r}; use one of {ACTIONS}")

    @property
    def holds(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _count_metrics(expectations: Sequence[Expectation]) -> list[Column]:
    counts = [F.count(F.lit(1)).alias(ROWS_METRIC)]
    counts += [F.count_if(~e.holds).alias(e.name) for e in expectations]
    return counts


def enforce(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Rows that pass every drop expectation; a fail expectation raises on its first bad row."""
    for e in expectations:
        if e.action == "fail":
            message = F.lit(f"expectation {e.name} failed: {e.predicate}")
            df = df.filter(F.when(e.holds, True).otherwise(F.raise_error(message).cast("boolean")))
        elif e.action == "drop":
            df = df.filter(e.predicate)  # bare, so that it can reach a parquet scan
    return df


def apply_expectations(
    df: DataFrame, expectations: Sequence[Expectation], observe_as: str | Observation | None = None
) -> DataFrame:
    """Kept rows. With ``observe_as`` the counts ride along with whatever job reads them.

    Pass a name for a streaming frame (its counts appear in the query progress) and an
    ``Observation`` for a batch frame.
    """
    if observe_as is not None:
        df = df.observe(observe_as, *_count_metrics(expectations))
    return enforce(df, expectations)


def expectation_counts(
    df: DataFrame, expectations: Sequence[Expectation], dataset: str
) -> DataFrame:
    """One row per expectation with passed and failed counts, from one aggregate pass."""
    counted = df.agg(*_count_metrics(expectations))
    entries = ", ".join(
        f"'{e.name}', '{e.action}', `{ROWS_METRIC}` - `{e.name}`, `{e.name}`" for e in expectations
    )
    return counted.select(
        F.lit(dataset).alias("dataset"),
        F.expr(
            f"stack({len(expectations)}, {entries}) as (expectation, action, passed, failed)"
        ),
    )


def event_log_rows(
    spark: SparkSession,
    run_id: str,
    dataset: str,
    expectations: Sequence[Expectation],
    batches: Iterable[dict],
) -> DataFrame:
    """Event-log rows from the observed counts of each micro-batch of one run."""
    totals: dict[str, int] = {}
    for batch in batches:
        for name, value in batch.items():
            totals[name] = totals.get(name, 0) + int(value or 0)
    rows = totals.get(ROWS_METRIC, 0)
    return spark.createDataFrame(
        [
            (run_id, dataset, e.name, e.action, rows - totals.get(e.name, 0), totals.get(e.name, 0))
            for e in expectations
        ],
        EVENT_LOG_SCHEMA,
    )
