"""Queries of stored models, certificates, the run log and time-forward search."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from riskgrid.plans import models as M
from riskgrid.plans import oracle_sql as O
from riskgrid.plans.feature_table import feature_table, grid_features
from riskgrid.plans.queries import CHOSEN_VARIANT, P, query
from riskgrid.schema import VARIANTS
from riskgrid.session import checkpoint_dir, materialize

#: Time of the stand-in refresh: the day after the catalog's last.
REFRESHED_AT = dt.datetime(2001, 8, 2)


def _store(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/riskgrid-{name}/{uuid.uuid4().hex}"


def _table(spark, sf):
    return feature_table(spark, sf, P, written=True)


def _regions():
    return [r.name for r in P.regions]


# --- X4: stored model, weekly forecast --------------------------------------

def _stored_forecast(spark, sf):
    """(fitted in memory, stored and loaded again, rows to score)."""
    from riskgrid.plans.model_store import load_model, save_model
    table = _table(spark, sf)
    _, (fitted,) = M.ablation(table, [CHOSEN_VARIANT])
    root = _store(spark, "models")
    save_model(fitted, table.filter(F.col("split") == "train"), root, REFRESHED_AT)
    return fitted, load_model(spark, root, fitted.run), grid_features(spark, sf, P)


@query("asof_forecast")
def q_asof_forecast(spark, sf):
    """Probability of a large event in the next 7 days, per region, by a model loaded from the store."""
    from riskgrid.plans.model_store import forecast
    _, loaded, features = _stored_forecast(spark, sf)
    return forecast(loaded, features).orderBy(F.col("score").desc(), "region")


@query("asof_scores", O.with_ft(
    "SELECT region, date, CAST(1 AS BIGINT) AS scores, true AS in_range, true AS as_fitted FROM feats WHERE date = (SELECT max(date) FROM feats)"))
def q_asof_scores(spark, sf):
    """Every region's newest day has one score by the stored model, a probability, equal to the fitted model's."""
    from riskgrid.plans.model_store import forecast
    fitted, loaded, features = _stored_forecast(spark, sf)
    own = forecast(fitted, features).select("region", "date", F.col("score").alias("fitted_score"))
    both = forecast(loaded, features).join(own, ["region", "date"], "full")
    return both.groupBy("region", "date").agg(
        F.count("score").alias("scores"), F.coalesce(F.min(F.col("score").between(0.0, 1.0)), F.lit(False)).alias("in_range"),
        F.coalesce(F.min(F.col("score") == F.col("fitted_score")), F.lit(False)).alias("as_fitted"))


# --- Certificates of M1, M5, M6, M9 -----------------------------------------

def _certified(runs: str, where: str = "true") -> str:
    """Every run, the rows it scores by split, and that it is the optimum."""
    return O.with_ft(f"""SELECT run, split, COUNT(*) AS rows, true AS residual_ok
FROM ft CROSS JOIN (VALUES {runs}) r(run, own) WHERE split IN ('train', 'validate') AND {where} GROUP BY run, split""")


@query("logreg_certificate", _certified(f"('logreg_{CHOSEN_VARIANT}', '')"))
def q_logreg_certificate(spark, sf):
    """M1: the fitted coefficients are the optimum of the weighted, penalised loss on the train rows."""
    table = _table(spark, sf)
    _, fitted = M.ablation(table, [CHOSEN_VARIANT])
    return M.certificates([(table, fitted)])


@query("ablation_certificate", _certified(", ".join(f"('logreg_{v}', '')" for v in VARIANTS)))
def q_ablation_certificate(spark, sf):
    """M9: the same for all eight variants, in one pass over the train rows."""
    table = _table(spark, sf)
    _, fitted = M.ablation(table)
    return M.certificates([(table, fitted)])


@query("per_region_certificate", _certified(", ".join(f"('{r.name}|{v}', '{r.name}')" for r in P.regions for v in VARIANTS), "region = own"))
def q_per_region_certificate(spark, sf):
    """M5: the same for every region and variant, each on its own region's rows."""
    table = _table(spark, sf)
    _, fitted = M.per_region(table, _regions())
    own = {r: [m for m in fitted if m.run.split("|")[0] == r] for r in _regions()}
    return M.certificates([(table.filter(F.col("region") == r), ms) for r, ms in own.items()])


@query("interaction_certificate", _certified(", ".join(f"('{run}', '')" for _, run in M.INTERACTION_EXPERIMENTS)))
def q_interaction_certificate(spark, sf):
    """M6: the same for both interaction models."""
    table = _table(spark, sf)
    _, fitted = M.interaction_runs(table, _regions())
    groups = []
    for (feats, _), m in zip(M.INTERACTION_EXPERIMENTS, fitted):
        t = table
        for f in feats:
            t, _ = M.interactions(t, f, _regions())
        groups.append((t, [m]))
    return M.certificates(groups)


# --- X4 / section 7.4: incremental refresh -----------------------------------

@query("refreshed_features", O.with_ft("SELECT * FROM feats"))
def q_refreshed_features(spark, sf):
    """Features kept up to date batch by batch (history, a batch with late rows, the newest weeks, the late batch
    again) equal those built at once from all events."""
    from riskgrid.plans.feature_table import enriched_catalog
    from riskgrid.plans.refresh import RefreshStore
    events = materialize(enriched_catalog(spark, sf, P), "refresh-catalog")
    late = F.col("id") % 997 == 0  # when an event lands; every event does
    landed = (F.when((F.col("date") < F.lit(dt.date(2001, 5, 1))) & ~late, 1)
              .when(F.col("date") < F.lit(dt.date(2001, 7, 1)), 2).otherwise(3))
    events = events.withColumn("landed", landed)
    store = RefreshStore(spark, _store(spark, "refresh"), P)
    for number in (1, 2, 3, 2):
        store.apply(events.where(F.col("landed") == number).drop("landed"), number)
    return store.features()


# --- X3 / X5: time-forward search --------------------------------------------

from riskgrid.plans.queries import _CUTOFFS as CUTOFFS  # noqa: E402
from riskgrid.plans.search import GRID, fold, folded, search  # noqa: E402

FOLD_DAYS = 365


@query("expanding_search")
def q_expanding_search(spark, sf):
    """Average precision of each config on each expanding fold, the mean, and the one chosen."""
    return search(_table(spark, sf), P.split, CUTOFFS, FOLD_DAYS)[1]


def _folds_sql():
    parts = []
    for end in CUTOFFS:
        case = O.split_case("date", fold(end, FOLD_DAYS, P.split.embargo_days))
        parts.append(f"SELECT DATE '{end}' AS train_end, {case} AS split, region, date FROM ft WHERE date + 7 < DATE '{P.split.test_start}'")
    folds = "\nUNION ALL\n".join(parts)
    return O.with_ft(f"""SELECT train_end, split, COUNT(*) AS rows, MAX(date) AS last_day,
       CASE WHEN split = 'validate' THEN {len(GRID)} * COUNT(*) ELSE 0 END AS scored, MAX(date) + 7 >= DATE '{P.split.test_start}' AS sealed_days
FROM ({folds}) f WHERE split IN ('train', 'validate') GROUP BY train_end, split""")


@query("expanding_search_folds", _folds_sql())
def q_expanding_search_folds(spark, sf):
    """Rows and last day of each fold, validation rows scored by all configs, and whether any lies in the sealed block."""
    table = _table(spark, sf)
    scores, _ = search(table, P.split, CUTOFFS, FOLD_DAYS)
    scored = scores.groupBy("train_end").agg(F.count("score").alias("n"))
    rows = M._union([folded(table, P.split, end, FOLD_DAYS).select(F.lit(end).alias("train_end"), "split", "date") for end in CUTOFFS])
    per = rows.groupBy("train_end", "split").agg(F.count(F.lit(1)).alias("rows"), F.max("date").alias("last_day"))
    return per.join(scored, "train_end", "left").select(
        "train_end", "split", "rows", "last_day", F.when(F.col("split") == "validate", F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("scored"),
        (F.date_add("last_day", P.horizon) >= F.lit(P.split.test_start)).alias("sealed_days"))


# --- E10 / X6: the run log of all runners, drift between runs -----------------

@query("run_log_all")
def q_run_log_all(spark, sf):
    """One run of every runner (variants, per region, interactions, reference scorers), as it is logged."""
    return M.all_runs(_table(spark, sf), _regions())


#: What the first of two logged refreshes had seen of the validation block.
_SEEN = dt.date(1999, 12, 31)


def _drift_sql():
    def one(n, where):
        return (f"SELECT {n} AS k, * FROM (WITH ft AS (SELECT * FROM ft_all WHERE {where}),\n{O.metrics_cte()}\nSELECT * FROM metrics)")
    return O.with_ft(f"""SELECT run, split, region, metric, round(previous, 9) AS previous, round(current, 9) AS current, round(current - previous, 9) AS change,
       COALESCE(CASE WHEN metric = 'log_loss' THEN current - previous ELSE previous - current END > 0.02, false) AS drift
FROM (SELECT run, split, region, metric, MAX(value) FILTER (WHERE k = 1) AS previous, MAX(value) FILTER (WHERE k = 2) AS current
      FROM ({one(1, f"NOT (split = 'validate' AND date > DATE '{_SEEN}')")} UNION ALL {one(2, "true")}) l GROUP BY ALL) d
WHERE current IS NOT NULL""", "ft_all AS (SELECT * FROM ft)")


@query("run_drift", _drift_sql())
def q_run_drift(spark, sf):
    """Change of every logged metric of the reference scorers between the last two logged runs, and which fell."""
    from riskgrid.plans.scoring import closed_form_metrics
    table, path = _table(spark, sf), _store(spark, "runs")
    earlier = table.where(~((F.col("split") == "validate") & (F.col("date") > F.lit(_SEEN))))
    for run_id, rows, at in (("refresh-1", earlier, REFRESHED_AT - dt.timedelta(days=7)), ("refresh-2", table, REFRESHED_AT)):
        M.append_runs(M.run_log(closed_form_metrics(rows), []), path, run_id, at)
    d = M.drift(spark.read.parquet(path), max_fall=0.02)
    return d.select("run", "split", "region", "metric", *[F.round(c, 9).alias(c) for c in ("previous", "current", "change")], "drift")
