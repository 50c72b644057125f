"""Profiling operators (D1-D14): data-quality and exploratory statistics.

All are aggregates; event-grain work is map-side combined before any shuffle.
No ordered window runs over a whole region's raw events: inter-event gaps are
taken inside (region, time range) partitions of distinct timestamps plus one
boundary gap per range, and exact medians come from value histograms with
range-bucketed prefix sums (``operators.ranking``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.functions.columns import nan_to_null
from riskgrid.operators.grid import threshold_of


def _stack(df: DataFrame, names, value_of, label: str = "feature") -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias(label), *[v(n).alias(k) for k, v in value_of.items()])
                      for n in names])
    return df.select(F.explode(pairs).alias("_s")).select("_s.*")


# D1
def null_rates(df: DataFrame, columns) -> DataFrame:
    """Rows, nulls and null share per column (NaN counted as missing)."""
    def missing(c):
        dt = df.schema[c].dataType.typeName()
        m = F.col(c).isNull()
        return m | F.isnan(F.col(c)) if dt in ("double", "float") else m
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(missing(c)).alias(f"_n_{c}") for c in columns])
    out = _stack(agg, columns, {"rows": lambda c: F.col("_rows"), "nulls": lambda c: F.col(f"_n_{c}")})
    return out.withColumn("null_rate", F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")))


# D2
def duplicates(df: DataFrame, id_col: str = "id") -> DataFrame:
    ids = df.groupBy(id_col).count().agg(F.count_if(F.col("count") > 1).alias("duplicate_ids"),
                                         F.sum("count").alias("n_rows"))
    # Equal rows have equal ids: only rows of repeated and null ids are compared as a whole.
    repeated = df.groupBy(F.col(id_col).alias("_id")).count().where("count > 1").select("_id")
    suspects = df.join(repeated, F.col(id_col).eqNullSafe(F.col("_id")), "left_semi")
    rows = suspects.groupBy(*df.columns).count().select(F.count_if(F.col("count") > 1)).scalar()
    return ids.select("n_rows", "duplicate_ids", rows.alias("duplicate_rows"))


# D3
def magnitude_summary(df: DataFrame, regions, flat: float) -> DataFrame:
    """Per region: n, exact median, min, max, share >= regional threshold, share >= a flat one.

    The median comes from the distributed value histogram (``exact_median``), not
    from a per-group buffer of every value: a region with a third of all events
    and a continuous magnitude would not fit one task's memory.
    """
    mag = F.col("magnitude")
    agg = df.groupBy("region").agg(
        F.count(F.lit(1)).alias("n"), F.min(mag).alias("min"), F.max(mag).alias("max"),
        F.avg((mag >= threshold_of(F.col("region"), regions)).cast("double")).alias("share_large"),
        F.avg((mag >= F.lit(flat)).cast("double")).alias("share_flat"))
    med = exact_median(df.filter(mag.isNotNull()).select("region", "magnitude"), ["region"], "magnitude")
    return agg.join(med, "region", "left").select("region", "n", "median", "min", "max",
                                                 "share_large", "share_flat")


# D4
def anomaly_counts(df: DataFrame, big: float, wide_gap: float = 320.0) -> DataFrame:
    """Implausible values; the azimuthal gap is judged where the catalog has one."""
    gaps = [F.count_if(F.col("gap") > F.lit(wide_gap)).alias("n_wide_gap")] if "gap" in df.columns else []
    return df.agg(
        *gaps,
        F.count_if(F.col("depth_km") < 0).alias("negative_depths"),
        F.min("depth_km").alias("min_depth"), F.max("depth_km").alias("max_depth"),
        F.max(nan_to_null("magnitude")).alias("max_magnitude"),
        F.count_if(nan_to_null("magnitude") >= F.lit(big)).alias("n_big"))


# D5
def removed_by_region(df: DataFrame, keep_type: str) -> DataFrame:
    kept = F.coalesce(F.col("type") == F.lit(keep_type), F.lit(False))
    return df.groupBy("region").agg(F.count(F.lit(1)).alias("rows_before"),
                                    F.count_if(~kept).alias("rows_removed"),
                                    F.count_if(kept).alias("rows_after"))


# D6
def catalog_shift(df: DataFrame, drop_ratio: float = 0.5, time_col: str = "time") -> DataFrame:
    """Events per (region, year) and the ratio to the previous year; flags sharp drops.

    Every year from a region's first to the catalog's last has a row, so a silent
    year counts 0 and is a drop.
    """
    seen = df.groupBy("region", F.year(time_col).alias("year")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("year").isNotNull())
    last = seen.select(F.max("year")).scalar()
    years = seen.groupBy("region").agg(F.explode(F.sequence(F.min("year"), last)).alias("year"))
    y = years.join(seen.withColumnRenamed("region", "_region").withColumnRenamed("year", "_year"),
                   F.col("region").eqNullSafe(F.col("_region")) & (F.col("year") == F.col("_year")), "left") \
        .select("region", "year", F.coalesce("n", F.lit(0)).alias("n"))
    prev = F.lag("n").over(Window.partitionBy("region").orderBy("year"))
    return (y.withColumn("prev_n", prev)
            .withColumn("ratio", F.when(F.col("prev_n") > 0, F.col("n") / F.col("prev_n")))
            .withColumn("sharp_drop", F.coalesce(F.col("ratio") < F.lit(drop_ratio), F.lit(False))))


# D7
def status_mix(df: DataFrame) -> DataFrame:
    s = df.groupBy("region", F.lower("status").alias("status")).agg(F.count(F.lit(1)).alias("n"))
    return s.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("region")))


# D8 / D9
def correlations(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pooled and within-region Pearson r, with the number of pairs and the t statistic.

    A pair needs both values: rows with a null or NaN on either side count for nothing.
    """
    pairs = df.select("region", nan_to_null(x).alias("_x"), nan_to_null(y).alias("_y"))
    n = F.count_if(F.col("_x").isNotNull() & F.col("_y").isNotNull()).alias("n")
    pooled = pairs.agg(F.lit("pooled").alias("scope"), n, F.corr("_x", "_y").alias("r"))
    within = pairs.groupBy(F.col("region").alias("scope")).agg(n, F.corr("_x", "_y").alias("r"))
    both = pooled.unionByName(within)
    t = F.col("r") * F.sqrt((F.col("n") - 2) / (F.lit(1.0) - F.col("r") * F.col("r")))
    return both.withColumn("t_stat", F.when((F.col("n") > 2) & (F.abs(F.col("r")) < 1), t))


# D10
def _micros(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def distinct_times(df: DataFrame, time_col: str = "time") -> DataFrame:
    """(region, us, c): distinct event instants per region with their multiplicity."""
    return df.groupBy("region", _micros(F.col(time_col)).alias("us")).agg(F.count(F.lit(1)).alias("c"))


def inter_event_gaps(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Every gap (microseconds) between consecutive events of a region, as (region, gap, w).

    Events collapse to distinct timestamps with counts first (c events at one
    instant give c-1 zero gaps), so a burst of identical times is one row. Each
    region's distinct timestamps are cut into quantile ranges; gaps are lags
    inside a (region, range) partition plus one boundary gap per range (its
    first timestamp minus the previous non-empty range's last). No task holds
    more than one range of one region.
    """
    return _gaps(ranged_times(df, time_col))


def ranged_times(df: DataFrame, time_col: str = "time") -> DataFrame:
    """``distinct_times``, written, with the quantile range ``_r`` of each instant in its region."""
    from riskgrid.operators.ranking import with_ranges
    return with_ranges(distinct_times(df, time_col), ["region"], "us")


def _gaps(r: DataFrame) -> DataFrame:
    zeros = r.filter(F.col("c") > 1).select("region", F.lit(0).cast("bigint").alias("gap"),
                                             (F.col("c") - 1).alias("w"))
    inside = (r.withColumn("gap", F.col("us") - F.lag("us").over(Window.partitionBy("region", "_r").orderBy("us")))
              .filter(F.col("gap").isNotNull()).select("region", "gap", F.lit(1).cast("bigint").alias("w")))
    per = r.groupBy("region", "_r").agg(F.min("us").alias("lo"), F.max("us").alias("hi"))
    across = (per.withColumn("gap", F.col("lo") - F.lag("hi").over(Window.partitionBy("region").orderBy("_r")))
              .filter(F.col("gap").isNotNull()).select("region", "gap", F.lit(1).cast("bigint").alias("w")))
    return zeros.unionByName(inside).unionByName(across)


def exact_median(values: DataFrame, keys, value: str, weight: str | None = None) -> DataFrame:
    """Exact (interpolated) median per group via a histogram of distinct values.

    ``weight`` (optional) is a per-row multiplicity. Positions come from
    range-bucketed prefix sums (``ranking.prefix_sums``), so a group with many
    distinct values is spread over many tasks.
    """
    from riskgrid.operators.ranking import prefix_sums
    w = F.sum(weight) if weight else F.count(F.lit(1))
    h = values.groupBy(*keys, value).agg(w.alias("_c"))
    tot = h.groupBy(*keys).agg(F.sum("_c").alias("_tot"))
    h = prefix_sums(h, keys, value, ["_c"]).join(tot, list(keys))
    lo_pos = F.floor((F.col("_tot") + 1) / 2)
    hi_pos = F.floor(F.col("_tot") / 2) + 1
    hit = lambda pos: (F.col("cum__c") - F.col("_c") < pos) & (F.col("cum__c") >= pos)
    return h.groupBy(*keys).agg(
        ((F.max(F.when(hit(lo_pos), F.col(value))).cast("double")
          + F.max(F.when(hit(hi_pos), F.col(value))).cast("double")) / 2).alias("median"))


def inter_event_time(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Per region: number of gaps, mean and median gap in hours."""
    # Count and span from the written table that the gaps use: one scan of the events.
    times = ranged_times(df, time_col)
    span = times.groupBy("region").agg(
        F.sum("c").alias("n"), F.min("us").alias("lo"), F.max("us").alias("hi"))
    mean = span.select("region", (F.col("n") - 1).alias("n_gaps"),
                       F.when(F.col("n") > 1, (F.col("hi") - F.col("lo")) / (F.col("n") - 1) / F.lit(3.6e9))
                       .alias("mean_gap_h"))
    med = exact_median(_gaps(times), ["region"], "gap", "w") \
        .select("region", (F.col("median") / F.lit(3.6e9)).alias("median_gap_h"))
    return mean.join(med, "region", "left")


# D11
def surge(filled: DataFrame, days: int = 30) -> DataFrame:
    """Largest ratio of a day's count to the mean of the previous ``days`` days, per region."""
    n = F.coalesce(F.col("n"), F.lit(0))
    prior = F.sum(n).over(Window.partitionBy("region").orderBy("date").rowsBetween(-days, -1))
    r = filled.select("region", "date", n.alias("n"), prior.alias("prior"))
    r = r.withColumn("ratio", F.when(F.col("prior") > 0, (F.col("n") * F.lit(float(days))) / F.col("prior")))
    top = r.filter(F.col("ratio").isNotNull()).groupBy("region").agg(
        F.max("ratio").alias("max_surge"),
        F.min_by("date", F.struct(-F.col("ratio"), F.col("date"))).alias("surge_date"))
    return top


# D12
def seasonality(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Month counts -> chi-square against a flat profile of twelve months; the top month and its top year.

    A month without events has no row: it adds its whole expected count.
    """
    m = df.groupBy("region", F.month(time_col).alias("month"), F.year(time_col).alias("year")) \
          .agg(F.count(F.lit(1)).alias("n"))
    months = m.groupBy("region", "month").agg(F.sum("n").alias("n"))
    tot = F.sum("n").over(Window.partitionBy("region"))
    months = months.withColumn("e", tot / F.lit(12.0))
    chi = months.groupBy("region").agg(
        (F.sum((F.col("n") - F.col("e")) * (F.col("n") - F.col("e")) / F.col("e"))
         + (F.lit(12) - F.count(F.lit(1))) * F.max("e")).alias("chi2"),
        F.count(F.lit(1)).alias("months_seen"),
        F.min_by("month", F.struct(-F.col("n"), F.col("month"))).alias("top_month"),
        F.max("n").alias("top_month_n"))
    yr = m.join(chi.select("region", F.col("top_month").alias("month")), ["region", "month"])
    top_year = yr.groupBy("region").agg(F.min_by("year", F.struct(-F.col("n"), F.col("year"))).alias("top_year"),
                                        F.max("n").alias("top_year_n"))
    return chi.join(top_year, "region")


# D13
def threshold_compare(filled_two: DataFrame, horizon: int = 7) -> DataFrame:
    """7-day positive rate per region under regional vs flat thresholds."""
    fut = Window.partitionBy("region").orderBy("date").rowsBetween(1, horizon)
    seen = F.count(F.lit(1)).over(fut)

    def lab(c):
        return F.when(seen == horizon, (F.sum(F.coalesce(F.col(c), F.lit(0))).over(fut) >= 1).cast("double"))
    lab_df = filled_two.select("region", lab("large").alias("l_regional"), lab("large_flat").alias("l_flat"))
    return lab_df.groupBy("region").agg(F.avg("l_regional").alias("rate_regional"),
                                        F.avg("l_flat").alias("rate_flat"),
                                        F.count("l_regional").alias("n"))


# D14
def spatial_bins(df: DataFrame, deg: float = 10.0) -> DataFrame:
    return df.groupBy((F.floor(F.col("latitude") / deg) * deg).alias("lat_bin"),
                      (F.floor(F.col("longitude") / deg) * deg).alias("lon_bin")) \
             .agg(F.count(F.lit(1)).alias("n"))
