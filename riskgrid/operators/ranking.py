"""Ordered prefix sums per group without putting a whole group in one task.

Running totals over an ordering (cumulative counts for AP, positions for an
exact median, confusion counts per threshold) would naively need a window over
a group's whole ordered domain, i.e. one task per group. Instead:

1. write the input, count it, and cut each group's values into ranges at
   approximate quantiles. The cuts are written before they are used: they depend
   on the order in which sketches are merged, and every branch must see the same
   ones (the cuts only decide parallelism; results stay exact);
2. sum each range (one row per range) and take, with a small window over the
   ranges, the total of all earlier ranges: the range's offset;
3. inside each (group, range) a window gives the local running total; adding
   the offset gives the exact global running total.

No task sees more than one range of one group, of about ``ROWS_PER_RANGE`` rows
in the largest group. Null keys are a group of their own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.session import materialize

#: Rows of one range in the largest group, about; the number of ranges follows from a count.
ROWS_PER_RANGE = 1_000_000


def _null_safe_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Inner join on ``keys``, nulls equal; the right side's keys are dropped."""
    r = right.select(*[F.col(c).alias(f"_j_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"_j_{c}"]) for c in keys])
    return left.join(r, same).drop(*[f"_j_{c}" for c in keys])


def with_ranges(df: DataFrame, keys, order: str, descending: bool = False,
                ranges: int | None = None) -> DataFrame:
    """``df``, written, with ``_r``: the quantile range of ``order`` within ``keys`` (0 = first in order)."""
    k = list(keys)
    if not k:
        raise ValueError("with_ranges needs at least one key column")
    base = materialize(df, "ordered")
    if ranges is None:
        largest = base.groupBy(*k).count().agg(F.max("count")).first()[0] or 0
        ranges = max(1, -(-largest // ROWS_PER_RANGE))
    if ranges == 1:
        return base.withColumn("_r", F.lit(0))
    probs = [i / ranges for i in range(1, ranges)]
    cuts = materialize(base.groupBy(*k).agg(
        F.percentile_approx(order, probs, max(1000, 10 * ranges)).alias("_cuts")), "range-cuts")
    cmp = (lambda c: c > F.col(order)) if descending else (lambda c: c < F.col(order))
    # Nulls are first in ascending and last in descending order, as in a window.
    place = F.when(F.col(order).isNull(), ranges if descending else 0).otherwise(
        F.size(F.filter(F.col("_cuts"), cmp)))
    return _null_safe_join(base, cuts, k).withColumn("_r", place).drop("_cuts")


def prefix_sums(df: DataFrame, keys, order: str, sums, descending: bool = False,
                ranges: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (running total including the row) for each column in ``sums``.

    ``df`` has one row per distinct ``order`` value within ``keys`` (ties already
    collapsed), so running totals are unambiguous.
    """
    keys = list(keys) or []
    k = keys or ["_all"]
    base = df if keys else df.withColumn("_all", F.lit(0))
    o = F.col(order).desc() if descending else F.col(order).asc()
    ranged = with_ranges(base, k, order, descending, ranges)
    totals = ranged.groupBy(*k, "_r").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    earlier = Window.partitionBy(*k).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*k, "_r", *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_o_{c}")
                                        for c in sums])
    inside = Window.partitionBy(*k, "_r").orderBy(o).rowsBetween(Window.unboundedPreceding, 0)
    out = _null_safe_join(ranged, offsets, k + ["_r"]).select(
        *ranged.columns, *[(F.col(f"_o_{c}") + F.sum(c).over(inside)).alias(f"cum_{c}") for c in sums])
    out = out.drop("_r")
    return out.drop("_all") if not keys else out
