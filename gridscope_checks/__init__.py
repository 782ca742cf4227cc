"""Registered queries, their SQL and the projections of the driver tables they read."""

from gridscope_checks.registry import QUERIES, SQL
from gridscope_checks import queries_functions, queries_grid, queries_locate, queries_tables, queries_text  # noqa: F401

__all__ = ["QUERIES", "SQL"]
