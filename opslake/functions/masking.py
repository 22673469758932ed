"""Column masks for personal data.

``viewer`` says whether the reader may see plain values. A Python bool folds to a
constant, so a masked plan never evaluates the plain branch.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _unless_viewer(value: Column, masked: Column, viewer: bool | Column) -> Column:
    flag = viewer if isinstance(viewer, Column) else F.lit(bool(viewer))
    return F.when(flag, value).otherwise(masked)


def mask_tax_id(value: Column, viewer: bool | Column = False) -> Column:
    """Last four characters; NULL stays NULL. A value of four or fewer shows whole."""
    return _unless_viewer(value, F.concat(F.lit("***-*"), F.substring(value, -4, 4)), viewer)


def mask_email(value: Column, viewer: bool | Column = False) -> Column:
    """Domain only; NULL for NULL and for text without an at sign."""
    domain = F.get(F.split(value, "@"), F.lit(1))
    return _unless_viewer(value, F.concat(F.lit("***@"), domain), viewer)


def mask_ssn(value: Column, viewer: bool | Column = False) -> Column:
    """A constant, also for NULL."""
    return _unless_viewer(value, F.lit("XXXX"), viewer)


MASKS = {"mask_tax_id": mask_tax_id, "mask_email": mask_email, "mask_ssn": mask_ssn}


def register_sql_masks(
    spark: SparkSession,
    schema_by_mask: dict[str, str] | None = None,
    only: Collection[str] = tuple(MASKS),
) -> list[str]:
    """Create the masks as SQL functions ``name(val, is_viewer)`` and return their names.

    ``schema_by_mask`` maps a mask to the schema that holds its table, where it lasts; masks
    without one become temporary functions.
    """
    bodies = {
        "mask_tax_id": "concat('***-*', substring(val, -4))",
        "mask_email": "concat('***@', get(split(val, '@'), 1))",
        "mask_ssn": "'XXXX'",
    }
    created = []
    for name, body in bodies.items():
        if name not in only:
            continue
        schema = (schema_by_mask or {}).get(name)
        target = f"{schema}.{name}" if schema else name
        kind = "FUNCTION" if schema else "TEMPORARY FUNCTION"
        spark.sql(
            f"CREATE OR REPLACE {kind} {target}(val STRING, is_viewer BOOLEAN) "
            f"RETURNS STRING RETURN CASE WHEN is_viewer THEN val ELSE {body} END"
        )
        created.append(target)
    return created
