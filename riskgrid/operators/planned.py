"""Items the reference's docs plan but its code never built.

Kept small and built from the same operators: long windows as prefix-sum
differences (X1), per-region F1-optimal thresholds (X2), the as-of refresh row
(X4), expanding cutoffs (X5), a calibration table (X8), risk tiers relative to
the regional base rate (X9) and the complement of the type filter as a
covariate (X11).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.columns import FIXED_SCALE
from riskgrid.operators.split import split_of
from riskgrid.schema import SplitSpec


# X1 ------------------------------------------------------------------------
def long_windows(filled: DataFrame, years=(1, 3, 5), days_per_year: int = 365) -> DataFrame:
    """Mean magnitude over the last 1/3/5 years and the all-time max, per region-day.

    A sliding frame of 1,825 rows is recomputed per row; instead, running sums
    (one pass, O(1) per row) are differenced with ``lag`` on the dense grid.
    """
    o = Window.partitionBy("region").orderBy("date")
    run = o.rowsBetween(Window.unboundedPreceding, 0)
    base = filled.select("region", "date",
                         F.sum(F.coalesce("n", F.lit(0))).over(run).alias("_cn"),
                         F.sum(F.coalesce("mag_sum", F.lit(0)).cast("decimal(38,0)")).over(run).alias("_cs"),
                         F.max("mag_max").over(run).alias("max_mag_all"))
    cols = [F.col("region"), F.col("date"), F.col("max_mag_all")]
    for y in years:
        k = y * days_per_year
        n = F.col("_cn") - F.coalesce(F.lag("_cn", k).over(o), F.lit(0))
        s = F.col("_cs") - F.coalesce(F.lag("_cs", k).over(o), F.lit(0))
        cols.append(F.when(n != 0, s.cast("double") / n.cast("double") / F.lit(float(FIXED_SCALE)))
                    .alias(f"avg_mag_{y}y"))
    return base.select(*cols)


# X2 ------------------------------------------------------------------------
def best_thresholds(scored: DataFrame, keys=("run", "region")) -> DataFrame:
    """Per group, the score threshold (alarm at score >= t) with the highest F1.

    Candidates are the distinct scores; counts come from prefix sums over the
    distinct-score table (one row per distinct score, not per example). Ties
    in F1 go to the higher threshold (fewer alarms).
    """
    keys = list(keys)
    d = scored.groupBy(*keys, "score").agg(F.count_if(F.col("label") == 1).alias("pos"),
                                           F.count_if(F.col("label") == 0).alias("neg"))
    from riskgrid.operators.ranking import prefix_sums
    P = d.groupBy(*keys).agg(F.sum("pos").alias("P"))
    c = prefix_sums(d, keys, "score", ["pos", "neg"], descending=True).join(P, keys) \
        .select(*keys, "score", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"), "P")
    c = c.withColumn("f1", F.when(F.col("P") > 0, (2 * F.col("tp")) / (F.col("tp") + F.col("fp") + F.col("P"))))
    return c.filter(F.col("P") > 0).groupBy(*keys).agg(
        F.max_by("score", F.struct("f1", "score")).alias("threshold"), F.max("f1").alias("f1"))


# X4 ------------------------------------------------------------------------
def asof_rows(features: DataFrame) -> DataFrame:
    """The newest region-day of every region: what a weekly refresh would score."""
    last = features.select(F.max("date")).scalar()
    return features.filter(F.col("date") == last)


# X5 ------------------------------------------------------------------------
def expanding_splits(features: DataFrame, train_ends, horizon_days: int, embargo: int = 7) -> DataFrame:
    """Split sizes for a list of train cutoffs; validation is the next ``horizon_days``."""
    parts = []
    for end in train_ends:
        vs = end + dt.timedelta(days=1)
        ve = end + dt.timedelta(days=horizon_days)
        spec = SplitSpec(end, vs, ve, ve + dt.timedelta(days=1), embargo)
        s = split_of(F.col("date"), spec)
        parts.append(features.groupBy(s.alias("split")).agg(F.count(F.lit(1)).alias("rows"))
                     .filter(F.col("split").isNotNull())
                     .select(F.lit(end).alias("train_end"), "split", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# X8 ------------------------------------------------------------------------
def calibration(scored: DataFrame, bins: int = 10, keys=("run",)) -> DataFrame:
    """Score bins of equal width on [0, 1]: mean score vs observed positive rate."""
    b = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    return scored.groupBy(*keys, b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_score"),
        F.avg(F.col("label").cast("double")).alias("observed_rate"))


# X9 ------------------------------------------------------------------------
def risk_tiers(scored: DataFrame, base_rates: DataFrame, elevated: float = 1.0, high: float = 2.0) -> DataFrame:
    """low / elevated / high relative to the region's train base rate; counts and observed rates."""
    # One row per region; Spark's size estimate (autoBroadcastJoinThreshold) decides the
    # broadcast, and a shuffle join remains the plan beyond it.
    j = scored.join(base_rates, "region")
    tier = (F.when(F.col("score") >= F.col("base_rate") * high, F.lit("high"))
            .when(F.col("score") >= F.col("base_rate") * elevated, F.lit("elevated"))
            .otherwise(F.lit("low")))
    return j.groupBy("run", "region", tier.alias("tier")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("label").cast("double")).alias("observed_rate"))


# X11 -----------------------------------------------------------------------
def other_type_counts(catalog: DataFrame, keep_type: str, days: int = 30) -> DataFrame:
    """Daily count of non-kept event types and its trailing ``days`` sum (on event days)."""
    other = catalog.filter(~F.coalesce(F.col("type") == F.lit(keep_type), F.lit(False)))
    return other.groupBy("region", "date").agg(F.count(F.lit(1)).alias("n_other"))


# X7 ------------------------------------------------------------------------
def geodesic_distance_to_fault(events: DataFrame, segments, lat: str = "latitude",
                               lon: str = "longitude") -> DataFrame:
    """Great-circle km to the nearest boundary segment (the planar x111 rule's geodesic variant)."""
    from riskgrid.operators.sphere import nearest_segment_km
    rows = events.sparkSession.createDataFrame([(s.x1, s.y1, s.x2, s.y2) for s in segments], "x1 double, y1 double, x2 double, y2 double")
    return nearest_segment_km(events, rows, lat, lon)


# X6 ------------------------------------------------------------------------
def drift_flags(scored_by_year: DataFrame, yearly_counts: DataFrame, drop_ratio: float = 0.5,
                ap_drop: float = 0.1) -> DataFrame:
    """Per (region, year): event-count ratio to the previous year and the yearly AP of a
    fixed scorer with its change; flag a sharp count drop or an AP fall."""
    from riskgrid.operators.metrics import average_precision
    ap = average_precision(scored_by_year, ["region", "year"])
    j = yearly_counts.join(ap, ["region", "year"], "left")
    o = Window.partitionBy("region").orderBy("year")
    return (j.withColumn("ap_prev", F.lag("ap").over(o))
            .withColumn("drift", F.coalesce(F.col("ratio") < F.lit(drop_ratio), F.lit(False))
                        | F.coalesce(F.col("ap_prev") - F.col("ap") > F.lit(ap_drop), F.lit(False))))


# X10 -----------------------------------------------------------------------
def before_test(table: DataFrame, spec: SplitSpec) -> DataFrame:
    """Region-days whose label window ends before the sealed test block begins."""
    return table.where(F.date_add("date", spec.embargo_days) < F.lit(spec.test_start))


def hashed_split(df: DataFrame, train: float = 0.70, validate: float = 0.15) -> DataFrame:
    """Replace ``split`` by a deterministic pseudo-random one (a hash of region and day),
    ignoring time: the 'shuffled' control for the embargoed date split."""
    h = F.pmod(F.xxhash64("region", "date"), F.lit(100_000)) / 100_000.0
    s = F.when(h < train, "train").when(h < train + validate, "validate").otherwise("test")
    return df.withColumn("split", s)
