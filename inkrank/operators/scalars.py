"""One-row results used inside other plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalar(value: int | DataFrame) -> Column:
    """A number, or the single cell of a one-row frame as a scalar subquery."""
    return value.scalar() if isinstance(value, DataFrame) else F.lit(value)
