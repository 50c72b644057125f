"""Evaluation on DataFrames: AP, confusion metrics, log-loss, per-region rules.

A scored frame has one row per example with a label (0/1), a score and a 0/1
prediction, plus any grouping columns (run, split, region). Metrics come out in
long form ``(…keys, region, metric, value)``; ``region`` null means overall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.operators.ranking import prefix_sums

# Fixed value: probabilities are clipped this far from 0 and 1 in the log-loss
# (float64 machine epsilon).
LOGLOSS_EPS = 2.220446049250313e-16
# Distinct-score ranges per group for the AP prefix sums.


def decision(p: Column, threshold: float = 0.5) -> Column:
    """Alarm when p >= threshold (a tie at the threshold is positive)."""
    return (p >= F.lit(threshold)).cast("int")


# ---------------------------------------------------------------------------
# E1 average precision
# ---------------------------------------------------------------------------

def average_precision(scored: DataFrame, keys=(), score: str = "score", label: str = "label",
                      buckets: int | None = None, sets=None) -> DataFrame:
    """AP = sum over distinct scores (descending) of (R_k - R_{k-1}) * P_k.

    Ties are one step. Null when a group has no positive.
    Plan: collapse to distinct scores per group with positive/total counts
    (map-side combined), then exact cumulative counts in descending score
    order from ``ranking.prefix_sums`` (range offsets + per-range windows).
    No ordered window spans a whole group.

    ``sets`` (a list of key lists, each a subset of ``keys``; string keys)
    computes several grouping levels in one pass; a key a level does not group
    by comes out null.
    """
    keys = list(keys)
    if sets is not None:
        dist = (scored.groupingSets([list(s) + [score] for s in sets], *keys, score)
                .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count(F.lit(1)).alias("_n")))
        dist = _mark(dist, keys)
        k = keys
    else:
        k = keys or ["_all"]
        base = scored if keys else scored.withColumn("_all", F.lit(0))
        dist = (base.groupBy(*k, score)
                .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count(F.lit(1)).alias("_n")))
    steps = prefix_sums(dist, k, score, ["_pos", "_n"], descending=True, ranges=buckets) \
        .select(*k, "_pos", F.col("cum__pos").alias("_tp"), F.col("cum__n").alias("_seen"))
    out = steps.groupBy(*k).agg(
        F.sum(F.col("_pos") * (F.col("_tp") / F.col("_seen"))).alias("_s"),
        F.sum("_pos").alias("_p"))
    out = out.select(*k, F.when(F.col("_p") > 0, F.col("_s") / F.col("_p")).alias("ap"))
    if sets is not None:
        return _unmark(out, keys)
    return out.drop("_all") if not keys else out


# Stand-in for "not grouped by this key" so grouping-set rows join by name.
_ALL = "\u0000all"
# Stand-in for a missing region, so that it is not taken for "overall".
_NO_REGION = "\u0000none"


def _mark(df: DataFrame, keys) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(_ALL)).alias(c) if c in keys else F.col(c)
                       for c in df.columns])


def _unmark(df: DataFrame, keys) -> DataFrame:
    return df.select(*[F.when(F.col(c) != F.lit(_ALL), F.col(c)).alias(c) if c in keys else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------------------
# E2-E5 confusion metrics and log-loss
# ---------------------------------------------------------------------------

def confusion(scored: DataFrame, keys=(), label: str = "label", pred: str = "pred") -> DataFrame:
    y, p = F.col(label), F.col(pred)
    agg = scored.groupBy(*keys).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    return agg.select(
        *keys, "tp", "fp", "fn", "tn",
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(zero).alias("precision"),
        F.when(tp + fn > 0, tp / (tp + fn)).otherwise(zero).alias("recall"),
        F.when(2 * tp + fp + fn > 0, (2 * tp) / (2 * tp + fp + fn)).otherwise(zero).alias("f1"),
    )


# ---------------------------------------------------------------------------
# E6 per-region metrics (absent unless both classes are present)
# ---------------------------------------------------------------------------

def _long(df: DataFrame, keys, metrics) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                      for m in metrics])
    return df.select(*keys, F.explode(pairs).alias("_m")).select(*keys, "_m.metric", "_m.value")


def metric_table(scored: DataFrame, keys=("run", "split"), with_log_loss: bool = True,
                 label: str = "label") -> DataFrame:
    """Long metric rows: overall per ``keys`` and per region where both classes occur.

    Columns: keys..., region (null = overall), metric, value. Both levels come
    from grouping sets: one aggregate pass for the counts and log-loss, one AP
    pass. Rows without a region count overall only; they are no region.
    """
    keys = list(keys)
    scored = scored.withColumn("region", F.coalesce("region", F.lit(_NO_REGION)))
    cols = keys + ["region"]
    sets = [keys, cols]
    y, p = F.col(label), F.col("pred")
    pr = F.least(F.lit(1.0 - LOGLOSS_EPS), F.greatest(F.lit(LOGLOSS_EPS), F.col("score")))
    ll = F.when(y == 1, -F.ln(pr)).otherwise(-F.ln(F.lit(1.0) - pr))
    counts = scored.groupingSets(sets, *cols).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.avg(ll).alias("log_loss"), F.min(label).alias("_lo"), F.max(label).alias("_hi"))
    # Per-region rows exist only when the region has both classes.
    counts = counts.filter(F.col("region").isNull() | (F.col("_lo") != F.col("_hi")))
    ap = _mark(average_precision(scored, cols, label=label, sets=sets), cols)
    m = _unmark(_mark(counts, cols).join(ap, cols), cols) \
        .select(*cols, "tp", "fp", "fn", "log_loss", "ap") \
        .filter(F.col("region").isNull() | (F.col("region") != _NO_REGION))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    zero = F.lit(0.0)
    m = m.select(*cols, "ap", "log_loss",
                 F.when(tp + fp > 0, tp / (tp + fp)).otherwise(zero).alias("precision"),
                 F.when(tp + fn > 0, tp / (tp + fn)).otherwise(zero).alias("recall"),
                 F.when(2 * tp + fp + fn > 0, (2 * tp) / (2 * tp + fp + fn)).otherwise(zero).alias("f1"))
    names = ["ap", "f1", "precision", "recall"] + (["log_loss"] if with_log_loss else [])
    return _long(m, cols, names)


# ---------------------------------------------------------------------------
# E7-E9 comparisons over metric rows
# ---------------------------------------------------------------------------

def overfit_gap(metrics: DataFrame, metric: str = "ap") -> DataFrame:
    """Train minus validation value of one metric per run and region."""
    m = metrics.filter(F.col("metric") == metric)
    return (m.groupBy("run", "region")
            .agg(F.max(F.when(F.col("split") == "train", F.col("value"))).alias("train_value"),
                 F.max(F.when(F.col("split") == "validate", F.col("value"))).alias("validate_value"))
            .withColumn("gap", F.col("train_value") - F.col("validate_value")))


def best_per_region(metrics: DataFrame, metric: str = "ap", split: str = "validate") -> DataFrame:
    """Top run per region by a metric (ties broken by run name)."""
    m = metrics.filter((F.col("metric") == metric) & (F.col("split") == split) & F.col("region").isNotNull())
    w = Window.partitionBy("region").orderBy(F.col("value").desc(), F.col("run"))
    return (m.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") == 1)
            .select("region", "run", F.col("value").alias(metric)))


def leaderboard(metrics: DataFrame, regions, split: str = "validate") -> DataFrame:
    """Wide table: one row per run with overall metrics and per-region AP."""
    m = metrics.filter(F.col("split") == split)
    cols = [F.max(F.when(F.col("region").isNull() & (F.col("metric") == x), F.col("value"))).alias(f"val_{x}")
            for x in ("ap", "f1", "log_loss")]
    cols += [F.max(F.when((F.col("region") == r) & (F.col("metric") == "ap"), F.col("value")))
             .alias(f"ap_{r.lower().replace(' ', '_')}") for r in regions]
    return m.groupBy("run").agg(*cols).orderBy(F.col("val_ap").desc_nulls_last(), "run")
