"""Named queries over the given tables, and their independent SQL checks."""

from orderlens.plans import aggregate_queries, boundary_queries, row_queries  # noqa: F401
from orderlens.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
