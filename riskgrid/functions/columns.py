"""Scalar column helpers (null/NaN rules, exact sums)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sums of doubles depend on the order partitions are merged in. Quantities that
# are summed across events are carried as integers in millionths, so a sum is
# exact and identical whatever the partitioning; the average is divided last.
FIXED_SCALE = 1_000_000


def nan_to_null(c: Column | str) -> Column:
    """NaN compares greater than everything in Spark; the catalog treats it as missing."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def fixed_point(c: Column | str) -> Column:
    """Value in millionths as BIGINT (round half up)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * F.lit(float(FIXED_SCALE)) + F.lit(0.5)).cast("bigint")


def from_fixed(total: Column, count: Column) -> Column:
    """Mean from a fixed-point sum and an event count; null when count is 0."""
    return F.when(count != 0, total.cast("double") / count.cast("double") / F.lit(float(FIXED_SCALE)))
