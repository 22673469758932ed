"""Registered queries over the test tables, and their independent SQL."""

from opslake.checks import (  # noqa: F401  (they register queries)
    file_queries,
    serving_queries,
    table_queries,
)
from opslake.checks.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
