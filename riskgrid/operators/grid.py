"""Region dimension, large-event flag, daily tally, calendar grid, gap fill.

Scale notes: the daily tally is the only operator that touches raw events; it
is a hash aggregate with a map-side partial step, so a hot region (a third of
all events) is pre-combined per task before the shuffle and the shuffle only
carries one row per (task, region, day). Everything after it runs on
region-days, whose count is bounded by regions x calendar days, not by events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgrid.functions.columns import fixed_point, nan_to_null


def threshold_of(region: Column, regions) -> Column:
    """Threshold looked up from a literal map: a projection, not a join."""
    pairs = []
    for r in regions:
        pairs += [F.lit(r.name), F.lit(float(r.threshold))]
    return F.try_element_at(F.create_map(*pairs), region)


def large_flag(region: Column, magnitude: Column, regions) -> Column:
    """magnitude >= threshold of its region; NaN or null magnitude is not large."""
    return F.coalesce(nan_to_null(magnitude) >= threshold_of(region, regions), F.lit(False))


def with_large_flag(catalog: DataFrame, regions) -> DataFrame:
    return catalog.withColumn("is_large", large_flag(F.col("region"), F.col("magnitude"), regions))


def _fsum(c: str) -> Column:
    # pandas sums skip missing values and give 0 for an all-missing day.
    return F.coalesce(F.sum(fixed_point(nan_to_null(c))), F.lit(0)).cast("bigint")


def daily_tally(catalog: DataFrame, regions) -> DataFrame:
    """One row per (region, day) that has events, for every region in the input.

    Sums are exact fixed-point integers (see ``fixed_point``); the denominators
    later are the event count ``n`` (not the non-null count).
    """
    has_dist = "distance_to_fault_km" in catalog.columns
    mag = nan_to_null("magnitude")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        _fsum("magnitude").alias("mag_sum"),
        F.max(mag).alias("mag_max"),
        F.count_if(large_flag(F.col("region"), F.col("magnitude"), regions)).alias("large"),
        _fsum("depth_km").alias("depth_sum"),
        (_fsum("distance_to_fault_km") if has_dist else F.lit(None).cast("bigint")).alias("dist_sum"),
        _fsum("latitude").alias("lat_sum"),
        _fsum("longitude").alias("lon_sum"),
    ]
    day = F.col("date") if "date" in catalog.columns else F.to_date("time")
    return catalog.groupBy("region", day.alias("date")).agg(*aggs)


def calendar_bounds(tally: DataFrame) -> tuple[Column, Column]:
    """First and last day over all rows, including regions outside the list.

    One scalar subquery over the (small, materialized) tally returning both
    ends, evaluated once and inlined as a constant of the plan.
    """
    b = tally.select(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    return b.getField("lo"), b.getField("hi")


def daily_grid(spark: SparkSession, tally: DataFrame, regions) -> DataFrame:
    """Dense (region, date) skeleton: every listed region on every calendar day.

    A projection of the literal region list with an exploded day sequence; the
    row count is regions x days, independent of the event volume.
    """
    lo, hi = calendar_bounds(tally)
    names = F.array(*[F.lit(r.name) for r in regions])
    # One row per region spread over tasks; each task explodes its own regions' days.
    parts = max(1, min(len(regions), int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return (spark.range(0, len(regions), 1, parts)
            .select(F.element_at(names, (F.col("id") + 1).cast("int")).alias("region"))
            .select("region", F.explode(F.sequence(lo, hi)).alias("date")))


def gap_filled_tally(grid: DataFrame, tally: DataFrame) -> DataFrame:
    """Left join the grid to the tally: null tallies on quiet days."""
    return grid.join(tally, ["region", "date"], "left")
