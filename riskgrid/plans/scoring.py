"""Closed-form reference scorers (M3 prior, M4 persistence, plus a closed-form
activity probability) and their metric tables. No model fit: deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.operators.metrics import decision, metric_table

SCORED_SPLITS = ("train", "validate")
PROB_RUNS = ("prior", "activity")
RANK_RUNS = ("persistence",)


def _frame(table: DataFrame, run: str, score, pred) -> DataFrame:
    return table.select(F.lit(run).alias("run"), "split", "region", "date",
                        F.col("label_7d").alias("label"), score.cast("double").alias("score"),
                        pred.cast("int").alias("pred"))


def prior_scores(table: DataFrame) -> DataFrame:
    """No-skill prior: every row scores the train base rate; predicts the majority class."""
    rate = table.filter(F.col("split") == "train").select(F.avg(F.col("label_7d").cast("double"))).scalar()
    return _frame(table, "prior", rate, F.when(rate > 0.5, 1).otherwise(0))


def persistence_scores(table: DataFrame, signal: str = "large_30d") -> DataFrame:
    """Persistence heuristic: risk = recent large-event count; alarm if >= 1."""
    return _frame(table, "persistence", F.col(signal), (F.col(signal) >= 1).cast("int"))


def activity_scores(table: DataFrame) -> DataFrame:
    """Closed-form probability from recent activity: q7 / (q7 + 10); alarm at >= 0.5."""
    p = F.col("quakes_7d") / (F.col("quakes_7d") + F.lit(10.0))
    return _frame(table, "activity", p, decision(p))


def closed_form_scores(table: DataFrame, splits=SCORED_SPLITS) -> DataFrame:
    t = table.filter(F.col("split").isin(*splits))
    return prior_scores(t if "train" in splits else table).filter(F.col("split").isin(*splits)) \
        .unionByName(persistence_scores(t)).unionByName(activity_scores(t))


def closed_form_metrics(table: DataFrame, splits=SCORED_SPLITS) -> DataFrame:
    """Metric rows for all closed-form runs in one pass; log-loss only for probability runs."""
    scored = closed_form_scores(table, splits)
    m = metric_table(scored, ("run", "split"), True)
    return m.filter((F.col("metric") != "log_loss") | F.col("run").isin(*PROB_RUNS))
