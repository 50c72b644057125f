"""Time-forward model search (X3, X5): expanding folds, a parameter grid, one choice by mean validation AP.

Fold k trains on all region-days up to its cutoff and validates on the time behind it, both cut short by the
embargo, so no label of a fold's training reads its validation days. Folds end before the sealed test block. A
fold's train rows are cached once for all of the grid; fits run side by side as far as ``models.FIT_THREADS``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.operators.metrics import average_precision
from riskgrid.operators.planned import before_test
from riskgrid.operators.split import split_of
from riskgrid.plans import models as M
from riskgrid.schema import VARIANTS, SplitSpec
from riskgrid.session import materialize


@dataclass(frozen=True)
class Config:
    """One point of the grid: a fitter of ``models.FITTERS``, a variant, and the fitter's own parameters in order."""
    kind: str
    variant: str
    params: tuple = ()

    @property
    def name(self) -> str:
        return "_".join([self.kind, self.variant, *(f"{p:g}" for p in self.params)])


#: Penalty strengths of the logistic regression; iterations and depth of boosted trees.
GRID = (Config("logreg", "depth", (0.01,)), Config("logreg", "depth", (1.0,)), Config("logreg", "both", (1.0,)), Config("gbt", "depth", (20, 2)))


def fold(train_end: dt.date, days: int, embargo: int) -> SplitSpec:
    last = train_end + dt.timedelta(days=days)
    return SplitSpec(train_end, train_end + dt.timedelta(days=1), last, last + dt.timedelta(days=1), embargo)


def folded(table: DataFrame, spec: SplitSpec, train_end: dt.date, days: int) -> DataFrame:
    """The fold's train and validate rows; nothing of the test block of ``spec``."""
    own = split_of(F.col("date"), fold(train_end, days, spec.embargo_days))
    return before_test(table, spec).withColumn("split", own).where(F.col("split").isin("train", "validate"))


def search(table: DataFrame, spec: SplitSpec, cutoffs, days: int = 365, grid=GRID) -> tuple[DataFrame, DataFrame]:
    """(scores of every config on every fold's validation rows, ranking).

    Scores: ``config, train_end, region, date, label, score``. Ranking: ``config, train_end, ap, mean_ap, chosen``; the
    config with the highest mean AP is chosen, the first by name of equals.
    """
    parts = []
    for end in cutoffs:
        rows = folded(table, spec, end, days)
        train = rows.where("split = 'train'").cache()
        try:
            fitted = M._fit_all([(M.FITTERS[c.kind], (train, *VARIANTS[c.variant].columns(), c.name, *c.params)) for c in grid])
        finally:
            train.unpersist()
        for m in fitted:
            parts.append(M.score_splits(m, rows, ("validate",)).select(F.col("run").alias("config"), F.lit(end).alias("train_end"), "region", "date", "label", "score"))
    scores = materialize(M._union(parts), "search-scores")
    ap = average_precision(scores, ["config", "train_end"])
    mean = ap.groupBy("config").agg(F.avg("ap").alias("mean_ap"))
    first = F.row_number().over(Window.orderBy(F.col("mean_ap").desc_nulls_last(), "config")) == 1  # a row per config
    return scores, ap.join(mean.withColumn("chosen", first), "config").select("config", "train_end", "ap", "mean_ap", "chosen")
