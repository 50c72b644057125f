"""Trailing activity windows and the forward label on the dense region-day grid.

All frames are ROWS frames over ``partitionBy(region).orderBy(date)``; on a
dense grid one row is one day, so the frames are exact day windows. The current
day is included and only the past is read, except by the label, which reads
D+1..D+horizon and is null unless that future is fully observed.

All expressions share one partitioning and ordering, so Spark evaluates the
features, the trend and the label in a single Window operator after one
shuffle of region-days (no join of features to labels).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.columns import from_fixed


def _spec(partition=("region",), order="date"):
    return Window.partitionBy(*partition).orderBy(order)


def trailing(days: int, partition=("region",)):
    return _spec(partition).rowsBetween(-(days - 1), 0)


def _wide(c: str) -> Column:
    """Fixed-point day sums are added up as DECIMAL(38, 0): BIGINT would end at some 9e12 units."""
    return F.sum(F.col(c).cast("decimal(38,0)"))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def window_feature_columns(horizon: int = 7, partition=("region",)) -> dict[str, Column]:
    """Feature expressions over a gap-filled tally (see ``grid.gap_filled_tally``)."""
    w7, w30 = trailing(7, partition), trailing(30, partition)
    n7 = F.sum(_zero("n")).over(w7)
    n30 = F.sum(_zero("n")).over(w30)
    first = _spec(partition).rowsBetween(Window.unboundedPreceding, 0)
    last_event_day = F.last(F.when(_zero("n") > 0, F.col("date")), ignorenulls=True).over(first)
    return {
        "quakes_7d": n7,
        "quakes_30d": n30,
        "large_30d": F.sum(_zero("large")).over(w30),
        "avg_mag_7d": from_fixed(_wide("mag_sum").over(w7), n7),
        "avg_mag_30d": from_fixed(_wide("mag_sum").over(w30), n30),
        "max_mag_30d": F.max("mag_max").over(w30),
        "avg_depth_30d": from_fixed(_wide("depth_sum").over(w30), n30),
        "avg_dist_30d": from_fixed(_wide("dist_sum").over(w30), n30),
        "centroid_lat_30d": from_fixed(_wide("lat_sum").over(w30), n30),
        "centroid_lon_30d": from_fixed(_wide("lon_sum").over(w30), n30),
        "days_since_last": F.datediff(F.col("date"), last_event_day),
    }


def forward_label(horizon: int = 7, partition=("region",)) -> Column:
    """1 if any large event in D+1..D+horizon, 0 if none, null if not observable."""
    fut = _spec(partition).rowsBetween(1, horizon)
    seen = F.count(F.lit(1)).over(fut)
    return F.when(seen == horizon, (F.sum(_zero("large")).over(fut) >= 1).cast("int"))


def window_features(filled: DataFrame, horizon: int = 7, with_label: bool = True) -> DataFrame:
    """Add the 12 features (doubles) and ``label_7d`` to a gap-filled tally."""
    cols = window_feature_columns(horizon)
    exprs = [F.col("region"), F.col("date")] + [c.alias(k) for k, c in cols.items()]
    if with_label:
        exprs.append(forward_label(horizon).alias("label_7d"))
    exprs.append(trend_column().alias("trend_7d"))
    return filled.select(*exprs)


def trend_column(partition=("region",)) -> Column:
    """This week's count minus the count 7 days earlier; null while day D-7 is before the calendar.

    The earlier count is the trailing 7-day sum at D-7, i.e. the sum over rows
    D-13..D-7 (partial near the start, as the rolling count there is), so the
    trend shares the frame-based Window operator instead of lagging a computed
    column in a second one.
    """
    n = _zero("n")
    now = F.sum(n).over(trailing(7, partition))
    before = F.sum(n).over(_spec(partition).rowsBetween(-13, -7))
    exists = F.count(F.lit(1)).over(_spec(partition).rowsBetween(-7, -7)) == 1
    return F.when(exists, now - before)


def as_feature_table(df: DataFrame) -> DataFrame:
    """Final column order and types (counts as doubles, label as int)."""
    dbl = lambda c: F.col(c).cast("double").alias(c)
    cols = [F.col("date"),
            dbl("quakes_7d"), dbl("quakes_30d"), dbl("large_30d"), dbl("avg_mag_7d"),
            dbl("avg_mag_30d"), dbl("max_mag_30d"), dbl("avg_depth_30d"), dbl("avg_dist_30d"),
            dbl("centroid_lat_30d"), dbl("centroid_lon_30d"), dbl("trend_7d"),
            dbl("days_since_last"), F.col("region")]
    if "label_7d" in df.columns:
        cols.append(F.col("label_7d").cast("int").alias("label_7d"))
    if "split" in df.columns:
        cols.append(F.col("split"))
    return df.select(*cols)
