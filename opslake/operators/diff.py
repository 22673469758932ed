"""Row changes between two snapshots of a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHANGE = "change"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _keyed(keys: Sequence[str]) -> Column:
    """Whether a row has all parts of its key."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def one_per_key(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """One row per key: of several, the one with the largest values, column by column. Rows
    without a whole key stay as they are."""
    keys = _keys(key)
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.filter(_keyed(keys)).distinct().unionByName(df.filter(~_keyed(keys)))
    largest = (
        df.filter(_keyed(keys))
        .groupBy(*keys)
        .agg(F.max(F.struct(*values)).alias("__row"))
        .select(*keys, *[F.col(f"__row.{c}").alias(c) for c in values])
    )
    return largest.select(*df.columns).unionByName(df.filter(~_keyed(keys)))


def snapshot_diff(
    old: DataFrame, new: DataFrame, key: str | Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """``change`` (insert, update or delete) with the key and the row's columns.

    Inserts and updates carry the new values, deletes the old ones. ``compare`` limits which
    columns make a row count as changed; NULL equals NULL. A key that a snapshot repeats
    counts once (``one_per_key``), so the full outer join matches at most one row to one row.
    Rows without a key match nothing: they are deletes and inserts, and bypass the join
    instead of meeting in one of its tasks.
    """
    keys = _keys(key)
    values = [c for c in new.columns if c not in keys]
    lost = old.filter(~_keyed(keys)).select(F.lit("delete").alias(CHANGE), *keys, *values)
    gained = new.filter(~_keyed(keys)).select(F.lit("insert").alias(CHANGE), *keys, *values)
    old, new = (one_per_key(df.filter(_keyed(keys)), keys) for df in (old, new))
    compare = values if compare is None else [c for c in compare if c not in keys]
    before = old.select(
        *[F.col(k).alias(f"__old_{k}") for k in keys],
        F.struct(*[F.col(c) for c in values]).alias("__before"),
    )
    after = new.select(*keys, F.struct(*[F.col(c) for c in values]).alias("__after"))
    joined = before.join(after, [F.col(f"__old_{k}") == F.col(k) for k in keys], "full_outer")

    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"__before.{c}").eqNullSafe(F.col(f"__after.{c}"))
    change = (
        F.when(F.col("__before").isNull(), "insert")
        .when(F.col("__after").isNull(), "delete")
        .when(~same, "update")
    )
    kept = F.coalesce(F.col("__after"), F.col("__before"))
    matched = (
        joined.withColumn(CHANGE, change)
        .filter(F.col(CHANGE).isNotNull())
        .select(
            CHANGE,
            *[F.coalesce(F.col(k), F.col(f"__old_{k}")).alias(k) for k in keys],
            *[kept[c].alias(c) for c in values],
        )
    )
    return matched.unionByName(lost).unionByName(gained)


def apply_diff(old: DataFrame, diff: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """``old`` with the changes of ``diff`` carried out."""
    keys = _keys(key)
    untouched = old.filter(_keyed(keys)).join(diff.select(*keys), keys, "left_anti")
    upserts = diff.filter(F.col(CHANGE) != "delete").select(*old.columns)
    return untouched.select(*old.columns).unionByName(upserts)
