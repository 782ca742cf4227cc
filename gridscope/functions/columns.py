"""Small helpers shared by the column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value) -> Column:
    """A column from a column, a column name or a number."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def dbl(value) -> Column:
    return col(value).cast("double")
