"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL."""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import functions as F

from riskgrid.operators.grid import daily_grid, daily_tally, gap_filled_tally
from riskgrid.plans import oracle_sql as O
from riskgrid.plans.feature_table import enriched_catalog, feature_table, positive_rate
from riskgrid.schema import PipelineParams
from riskgrid.session import use_utc

QUERIES: dict = {}
SQL: dict = {}


def query(name, sql=None):
    def deco(fn):
        def run(spark, sf_dir):
            use_utc(spark)
            return fn(spark, sf_dir.rstrip("/"))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run
    return deco


P = PipelineParams()

TALLY_COLS = ["region", "date", "n", "mag_sum", "mag_max", "large", "depth_sum", "dist_sum",
              "lat_sum", "lon_sum"]


# --- P4 / A3: the flagship and the minimum slice ---------------------------

@query("feature_table", O.with_ft("SELECT * FROM ft"))
def q_feature_table(spark, sf):
    """Full 16-column feature table on the stand-in catalog."""
    return feature_table(spark, sf, P)


@query("positive_rate", O.with_ft("""
SELECT region, split, AVG(CAST(label_7d AS DOUBLE)) AS positive_rate, COUNT(*) AS n,
       AVG(quakes_7d) AS mean_quakes_7d
FROM ft GROUP BY region, split"""))
def q_positive_rate(spark, sf):
    """A3: 7-day positive rate, row count and mean activity by region and split."""
    return positive_rate(feature_table(spark, sf, P))


# --- A1 / J2 / J3 / J5 ------------------------------------------------------

@query("daily_tally", f"WITH {O.CATALOG},\n{O.enriched()},\n{O.tally()}\nSELECT * FROM tally")
def q_daily_tally(spark, sf):
    """A1 + A2: per (region, day) count, exact sums, max magnitude and large count."""
    return daily_tally(enriched_catalog(spark, sf, P), P.regions).select(*TALLY_COLS)


@query("daily_grid", f"WITH {O.CATALOG},\n{O.enriched()},\n{O.tally()},\n{O.grid()}\n"
                     "SELECT region, date FROM grid")
def q_daily_grid(spark, sf):
    """Every listed region on every calendar day of the catalog."""
    tally = daily_tally(enriched_catalog(spark, sf, P), P.regions)
    return daily_grid(spark, tally, P.regions)


@query("gap_filled_tally", f"WITH {O.CATALOG},\n{O.enriched()},\n{O.tally()},\n{O.grid()}\n"
                           "SELECT * FROM filled")
def q_gap_filled_tally(spark, sf):
    """Grid left-joined to the tally; null tallies on quiet days."""
    tally = daily_tally(enriched_catalog(spark, sf, P), P.regions)
    return gap_filled_tally(daily_grid(spark, tally, P.regions), tally).select(*TALLY_COLS)


@query("distance_to_line", f"WITH {O.CATALOG},\n{O.enriched()}\n"
                           "SELECT id, longitude, latitude, distance_to_fault_km FROM enriched")
def q_distance_to_line(spark, sf):
    """Planar distance (x 111 km) from every event to its nearest boundary segment."""
    return enriched_catalog(spark, sf, P).select("id", "longitude", "latitude", "distance_to_fault_km")


# --- W1-W8: window operators (all grid rows, before tail drop and split) ----

def _grid_feats(spark, sf):
    from riskgrid.operators.windows import as_feature_table
    from riskgrid.plans.feature_table import grid_features
    return as_feature_table(grid_features(spark, sf, P))


def _window_query(name, cols, doc):
    sql = O.with_ft(f"SELECT region, date, {', '.join(cols)} FROM feats")

    def fn(spark, sf):
        return _grid_feats(spark, sf).select("region", "date", *cols)
    fn.__doc__ = doc
    query(name, sql)(fn)


_window_query("window_counts", ["quakes_7d", "quakes_30d"], "W1: trailing 7/30-day event counts (0 when empty).")
_window_query("window_large", ["large_30d"], "W2: trailing 30-day count of large events.")
_window_query("window_averages", ["avg_mag_7d", "avg_mag_30d"],
              "W3: trailing mean magnitude, sum / event count, null when no events.")
_window_query("window_max", ["max_mag_30d"], "W4: trailing 30-day max magnitude, null when empty.")
_window_query("window_geology", ["avg_depth_30d", "avg_dist_30d"],
              "W5: trailing mean depth and distance to boundary (denominator = event count).")
_window_query("centroid", ["centroid_lat_30d", "centroid_lon_30d"], "W5: trailing 30-day activity centroid.")
_window_query("trend", ["trend_7d"], "W6: 7-day count minus the count 7 days earlier; null on first 7 days.")
_window_query("days_since_last", ["days_since_last"],
              "W7: days since the last event day; 0 on event days, null before the first.")
_window_query("forward_label", ["label_7d"],
              "W8: 1 if a large event in D+1..D+7, else 0; null on the last 7 days.")


# --- P1-P3 / A4: split -------------------------------------------------------

@query("temporal_split", O.with_ft(
    f"SELECT region, date, split FROM (SELECT region, date, {O.split_case('date')} AS split FROM feats) "
    "WHERE split IS NOT NULL"))
def q_temporal_split(spark, sf):
    """Embargoed split of every grid row (tail kept, embargo gaps dropped)."""
    from riskgrid.operators.split import assign_split
    return assign_split(_grid_feats(spark, sf), P.split, "date").select("region", "date", "split")


@query("temporal_split_events", f"WITH {O.CATALOG}\n"
       f"SELECT id, time, split FROM (SELECT id, time, {O.split_case('time')} AS split FROM catalog) "
       "WHERE split IS NOT NULL")
def q_temporal_split_events(spark, sf):
    """The same split at event grain, on the event timestamp."""
    from riskgrid.operators.split import assign_split
    from riskgrid.sources.tables import standin_catalog
    return assign_split(standin_catalog(spark, sf), P.split, "time").select("id", "time", "split")


@query("split_summary", O.with_ft("""
SELECT s.split, s.rows, CASE WHEN tr + va + te > 0 THEN s.rows / (tr + va + te) ELSE 0.0 END AS share,
       dropped, rows_in
FROM agg, (SELECT 'train' AS split, tr AS rows FROM agg UNION ALL SELECT 'validate', va FROM agg
           UNION ALL SELECT 'test', te FROM agg) s""", f"""kept AS (
  SELECT {O.split_case('date')} AS split FROM feats WHERE label_7d IS NOT NULL),
agg AS (SELECT COUNT(*) AS rows_in, COUNT(*) FILTER (WHERE split = 'train') AS tr,
               COUNT(*) FILTER (WHERE split = 'validate') AS va, COUNT(*) FILTER (WHERE split = 'test') AS te,
               COUNT(*) FILTER (WHERE split IS NULL) AS dropped FROM kept)"""))
def q_split_summary(spark, sf):
    """A4: rows per split, share of kept rows, rows dropped by the embargo."""
    from riskgrid.operators.split import drop_unobservable, split_summary
    return split_summary(drop_unobservable(_grid_feats(spark, sf)), P.split, "date")


# --- E1-E9 / M3 / M4: closed-form scorers and metrics ----------------------

ROUND = 12


def _metrics(spark, sf):
    from riskgrid.plans.scoring import closed_form_metrics
    return closed_form_metrics(feature_table(spark, sf, P, written=True))


def _r(c):
    return F.round(F.col(c), ROUND).alias(c)


def _rs(c):
    return f"round({c}, {ROUND}) AS {c}"


@query("average_precision", O.with_metrics(
    f"SELECT run, split, region, {_rs('value')} FROM metrics WHERE metric = 'ap'"))
def q_average_precision(spark, sf):
    """Step-wise average precision with tied scores grouped, overall and per region."""
    m = _metrics(spark, sf)
    return m.filter(F.col("metric") == "ap").select("run", "split", "region", _r("value"))


@query("confusion_metrics", O.with_ft(f"""
SELECT run, split, region, tp, fp, fn, tn, {_rs('precision')}, {_rs('recall')}, {_rs('f1')}
FROM {O.confusion_sql('scored', 'run, split, region')} k
UNION ALL
SELECT run, split, CAST(NULL AS VARCHAR), tp, fp, fn, tn, {_rs('precision')}, {_rs('recall')}, {_rs('f1')}
FROM {O.confusion_sql('scored', 'run, split')} k""", O.scored()))
def q_confusion_metrics(spark, sf):
    """tp/fp/fn/tn, precision, recall, F1 (0 when undefined), alarm at p >= 0.5."""
    from riskgrid.operators.metrics import confusion
    from riskgrid.plans.scoring import closed_form_scores
    s = closed_form_scores(feature_table(spark, sf, P, written=True))
    cols = ["tp", "fp", "fn", "tn", _r("precision"), _r("recall"), _r("f1")]
    by_region = confusion(s, ["run", "split", "region"]).select("run", "split", "region", *cols)
    overall = confusion(s, ["run", "split"]).select("run", "split", F.lit(None).cast("string").alias("region"),
                                                   *cols)
    return by_region.unionByName(overall)


@query("log_loss", O.with_metrics(
    f"SELECT run, split, region, {_rs('value')} FROM metrics WHERE metric = 'log_loss'"))
def q_log_loss(spark, sf):
    """Mean log-loss with probabilities clipped by float64 epsilon."""
    m = _metrics(spark, sf)
    return m.filter(F.col("metric") == "log_loss").select("run", "split", "region", _r("value"))


@query("metrics_by_region", O.with_metrics(
    f"SELECT run, split, region, metric, {_rs('value')} FROM metrics WHERE region IS NOT NULL"))
def q_metrics_by_region(spark, sf):
    """Per-region metrics, present only where the region has both classes."""
    m = _metrics(spark, sf)
    return m.filter(F.col("region").isNotNull()).select("run", "split", "region", "metric", _r("value"))


@query("baseline_prior", O.with_metrics(
    f"SELECT region, metric, {_rs('value')} FROM metrics WHERE run = 'prior' AND split = 'validate'"))
def q_baseline_prior(spark, sf):
    """M3: no-skill prior on validation (AP ~ base rate, F1 0 when predicting 0)."""
    m = _metrics(spark, sf)
    return m.filter((F.col("run") == "prior") & (F.col("split") == "validate")).select(
        "region", "metric", _r("value"))


@query("baseline_persistence", O.with_metrics(
    f"SELECT region, metric, {_rs('value')} FROM metrics WHERE run = 'persistence' AND split = 'validate'"))
def q_baseline_persistence(spark, sf):
    """M4: persistence heuristic (score = large_30d, alarm if >= 1) on validation."""
    m = _metrics(spark, sf)
    return m.filter((F.col("run") == "persistence") & (F.col("split") == "validate")).select(
        "region", "metric", _r("value"))


@query("overfit_gap", O.with_metrics(f"""
SELECT run, region, {_rs('train_value')}, {_rs('validate_value')}, {_rs('gap')} FROM (
  SELECT run, region, tv AS train_value, vv AS validate_value, tv - vv AS gap FROM (
    SELECT run, region, MAX(CASE WHEN split = 'train' THEN value END) AS tv,
           MAX(CASE WHEN split = 'validate' THEN value END) AS vv
    FROM metrics WHERE metric = 'ap' GROUP BY run, region) x) y"""))
def q_overfit_gap(spark, sf):
    """Train AP minus validation AP per run and region."""
    from riskgrid.operators.metrics import overfit_gap
    g = overfit_gap(_metrics(spark, sf))
    return g.select("run", "region", _r("train_value"), _r("validate_value"), _r("gap"))


@query("best_per_region", O.with_metrics(f"""
SELECT region, run, {_rs('ap')} FROM (
  SELECT region, run, value AS ap,
         ROW_NUMBER() OVER (PARTITION BY region ORDER BY value DESC, run) AS rk
  FROM metrics WHERE metric = 'ap' AND split = 'validate' AND region IS NOT NULL) t WHERE rk = 1"""))
def q_best_per_region(spark, sf):
    """Best run per region by validation AP (ties broken by run name)."""
    from riskgrid.operators.metrics import best_per_region
    return best_per_region(_metrics(spark, sf)).select("region", "run", _r("ap"))


def _leader_sql():
    regs = ", ".join(
        f"round(MAX(CASE WHEN region = '{r.name}' AND metric = 'ap' THEN value END), {ROUND}) "
        f"AS ap_{r.name.lower().replace(' ', '_')}" for r in P.regions)
    overall = ", ".join(
        f"round(MAX(CASE WHEN region IS NULL AND metric = '{x}' THEN value END), {ROUND}) AS val_{x}"
        for x in ("ap", "f1", "log_loss"))
    return O.with_metrics(f"SELECT run, {overall}, {regs} FROM metrics WHERE split = 'validate' GROUP BY run")


@query("leaderboard", _leader_sql())
def q_leaderboard(spark, sf):
    """One row per run with validation AP/F1/log-loss and per-region AP, ranked by AP."""
    from riskgrid.operators.metrics import leaderboard
    lb = leaderboard(_metrics(spark, sf), [r.name for r in P.regions])
    return lb.select("run", *[_r(c) for c in lb.columns if c != "run"])


# --- F8 / N1-N6: variant projection and preprocessing ----------------------

from riskgrid.schema import FEATURE_COLUMNS, VARIANTS  # noqa: E402

PREP_VARIANT = "depth"
DEC = 6


def _train(t):
    return t.filter(F.col("split") == "train")


@query("variant_projection", O.with_ft(
    "SELECT region, date, split, label_7d, quakes_7d, quakes_30d, large_30d, avg_mag_7d, avg_mag_30d, "
    "max_mag_30d, trend_7d, days_since_last, avg_depth_30d, avg_dist_30d FROM ft"))
def q_variant_projection(spark, sf):
    """F8: the columns of one variant ('both' = base + depth + distance) plus keys and label."""
    from riskgrid.operators.prep import variant_projection
    return variant_projection(feature_table(spark, sf, P), "both")


@query("impute_median", O.with_ft("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(median({c}), {ROUND}) AS median FROM ft WHERE split = 'train'"
    for c in FEATURE_COLUMNS)))
def q_impute_median(spark, sf):
    """Exact (interpolated) train median of every numeric feature."""
    from riskgrid.operators.prep import train_medians
    fitted = train_medians(_train(feature_table(spark, sf, P, written=True)), FEATURE_COLUMNS)
    rows = spark.createDataFrame(list(fitted.items()), "feature string, median double")  # a number per feature
    return rows.select("feature", F.round("median", ROUND).alias("median"))


def _prep_sql(numeric, cats, keep="region, date, split"):
    meds = ", ".join(f"median({c}) AS med_{c}" for c in numeric)
    mos = ", ".join(f"avg(COALESCE({c}, med_{c})) AS mu_{c}, stddev_pop(COALESCE({c}, med_{c})) AS sd_{c}"
                    for c in numeric)
    nums = ", ".join(
        f"round((COALESCE({c}, med_{c}) - mu_{c}) / CASE WHEN sd_{c} = 0 THEN 1.0 ELSE sd_{c} END, {DEC}) "
        f"AS num__{c}" for c in numeric)
    onehot = "".join(f", CAST(CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS cat__region_{r.lower().replace(' ', '_')}"
                     for r in cats)
    return O.with_ft(f"SELECT {keep}, {nums}{onehot} FROM ft, st, mo",
                     f"st AS (SELECT {meds} FROM ft WHERE split = 'train'),\n"
                     f"mo AS (SELECT {mos} FROM ft, st WHERE split = 'train')")


def _prep(spark, sf, numeric, with_cat):
    from riskgrid.operators.prep import fit_categories, fit_numeric, transform
    t = feature_table(spark, sf, P, written=True)
    stats = fit_numeric(_train(t), numeric)
    cats = fit_categories(_train(t), ["region"]) if with_cat else {}
    out = transform(t, numeric, cats, stats, keep=("region", "date", "split"))
    return out.select("region", "date", "split",
                      *[F.round(c, DEC).alias(c) if c.startswith("num__") else F.col(c)
                        for c in out.columns if c not in ("region", "date", "split")])


_DEPTH_NUM = list(VARIANTS[PREP_VARIANT].columns()[0])
_CATS = sorted(r.name for r in P.regions)


@query("standardize", _prep_sql(_DEPTH_NUM, []))
def q_standardize(spark, sf):
    """(imputed x - train mean) / train population std (1 when constant)."""
    return _prep(spark, sf, _DEPTH_NUM, False)


@query("one_hot", O.with_ft("SELECT region, date, split" + "".join(
    f", CAST(CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS cat__region_{r.lower().replace(' ', '_')}"
    for r in _CATS) + " FROM ft"))
def q_one_hot(spark, sf):
    """One 0/1 column per sorted train category; unseen -> zeros."""
    from riskgrid.operators.prep import fit_categories, one_hot
    t = feature_table(spark, sf, P, written=True)
    cats = fit_categories(_train(t), ["region"])
    return t.select("region", "date", "split", *one_hot("region", cats["region"]))


@query("preprocess", _prep_sql(_DEPTH_NUM, _CATS))
def q_preprocess(spark, sf):
    """The composed preprocessor (num__ block then cat__ block) for the chosen variant."""
    return _prep(spark, sf, _DEPTH_NUM, True)


@query("class_weights", O.with_ft(f"""
SELECT label_7d, n, n_class, round(n / (2 * n_class), {ROUND}) AS weight
FROM (SELECT label_7d, COUNT(*) AS n_class FROM ft WHERE split = 'train' GROUP BY label_7d) c,
     (SELECT COUNT(*) AS n FROM ft WHERE split = 'train') t"""))
def q_class_weights(spark, sf):
    """Balanced class weights n / (2 n_c) on train."""
    from riskgrid.operators.prep import class_weights
    w = class_weights(_train(feature_table(spark, sf, P, written=True)))
    return w.select("label_7d", "n", "n_class", F.round("weight", ROUND).alias("weight"))


@query("interactions", O.with_ft("SELECT region, date, split" + "".join(
    f", avg_dist_30d * CASE WHEN region = '{r}' THEN 1.0 ELSE 0.0 END AS avg_dist_30d__{r.lower().replace(' ', '_')}"
    for r in _CATS) + " FROM ft"))
def q_interactions(spark, sf):
    """Region x distance interactions by multiplication (a null stays null everywhere)."""
    from riskgrid.operators.prep import interactions
    t = feature_table(spark, sf, P)
    out, names = interactions(t, "avg_dist_30d", _CATS)
    return out.select("region", "date", "split", *names)


# --- G1-G6: leakage guards ----------------------------------------------------

def _guard_sql(ft="ft", fitted="quantile_cont(avg_mag_7d, 0.5) FILTER (WHERE split = 'train')"):
    """The guards' SQL over table ``ft``; ``fitted`` is the imputer's median."""
    emb = []
    for cid, a, z in ((1, "train", "validate"), (2, "validate", "test")):
        emb.append(
            f"SELECT {cid} AS check_id, 'embargo {a} -> {z}' AS guard, "
            f"COALESCE({a}_max + 7 < {z}_min, false) AS passed, "
            f"'{a}_max ' || COALESCE(CAST({a}_max AS VARCHAR), 'none') || ' + 7d < {z}_min ' || "
            f"COALESCE(CAST({z}_min AS VARCHAR), 'none') AS detail FROM (SELECT "
            f"max(CASE WHEN split = '{a}' THEN date END) AS {a}_max, min(CASE WHEN split = '{z}' THEN date END) AS {z}_min FROM {ft}) b")
    one = ("SELECT 3 AS check_id, 'one split per (region, date)' AS guard, COALESCE(m = 1, false) AS passed, "
           "'max distinct splits per key = ' || COALESCE(CAST(m AS VARCHAR), '0') AS detail "
           f"FROM (SELECT max(k) AS m FROM (SELECT count(DISTINCT split) AS k FROM {ft} GROUP BY region, date) x) y")
    from riskgrid.schema import LEAKAGE_COLUMNS
    roles = ", ".join(f"('{c}')" for c in LEAKAGE_COLUMNS)
    inputs = ", ".join(f"('{c}')" for c in sorted({c for v in VARIANTS.values() for part in v.columns() for c in part}))
    # The table's own columns, as DuckDB sees them, and the variants' inputs, against the excluded roles.
    forb = ("SELECT 4 AS check_id, 'leak-prone columns never used' AS guard, COUNT(c) = 0 AS passed, "
            "'excluded columns in use: ' || COALESCE(string_agg(c, ', ' ORDER BY c), 'none') AS detail FROM ("
            f"SELECT DISTINCT name AS c FROM (UNPIVOT (SELECT COLUMNS(*)::VARCHAR FROM {ft}) ON COLUMNS(*) INTO NAME name VALUE held) "
            f"WHERE name IN (SELECT * FROM (VALUES {roles}) r) UNION SELECT * FROM (VALUES {inputs}) i(c) WHERE c IN (SELECT * FROM (VALUES {roles}) r)) z")
    train = ("SELECT 5 AS check_id, 'preprocessing fit on train only' AS guard, COALESCE(abs(fitted - middle) < 1e-9, false) AS passed, "
             "'avg_mag_7d: fitted median = train median' AS detail FROM "
             f"(SELECT {fitted} AS fitted FROM {ft}) f, (SELECT avg(avg_mag_7d) AS middle FROM ("
             "SELECT avg_mag_7d, row_number() OVER (ORDER BY avg_mag_7d) AS rk, COUNT(*) OVER () AS n "
             f"FROM {ft} WHERE split = 'train' AND avg_mag_7d IS NOT NULL) r WHERE rk IN ((n + 1) // 2, n // 2 + 1)) m")
    lab = ("SELECT 6 AS check_id, 'label is a clean binary target' AS guard, nulls = 0 AND bad = 0 AS passed, "
           "'nulls=' || CAST(nulls AS VARCHAR) || ', non-binary=' || CAST(bad AS VARCHAR) AS detail FROM "
           "(SELECT COUNT(*) FILTER (WHERE label_7d IS NULL) AS nulls, "
           f"COUNT(*) FILTER (WHERE label_7d NOT IN (0, 1)) AS bad FROM {ft}) x")
    fwd = ("SELECT 7 AS check_id, 'label reads only D+1..D+7, features only <= D' AS guard, bad = 0 AS passed, "
           "'mismatched rows = ' || CAST(bad AS VARCHAR) AS detail FROM (SELECT COUNT(*) FILTER (WHERE "
           "label_7d <> CAST(fut >= 1 AS INTEGER) OR quakes_7d <> CAST(pn AS DOUBLE)) AS bad FROM ("
           "SELECT f.label_7d, f.quakes_7d, "
           "COALESCE((SELECT SUM(large) FROM tally t WHERE t.region = f.region AND t.date > f.date "
           "AND t.date <= f.date + 7), 0) AS fut, "
           "COALESCE((SELECT SUM(n) FROM tally t WHERE t.region = f.region AND t.date >= f.date - 6 "
           f"AND t.date <= f.date), 0) AS pn FROM {ft} f) x) y")
    return {"embargo": "\nUNION ALL\n".join(emb), "one": one, "forb": forb, "train": train, "label": lab, "fwd": fwd}


_G = _guard_sql()


def _ft_and_tally(spark, sf):
    from riskgrid.plans.feature_table import stored_tally
    return feature_table(spark, sf, P, written=True), stored_tally(spark, sf, P)


@query("guard_forbidden", O.with_ft(_G["forb"]))
def q_guard_forbidden(spark, sf):
    """Neither the table nor a variant uses a leak-prone detection column (nst, gap, dmin, rms)."""
    from riskgrid.operators.guards import guard_forbidden
    return guard_forbidden(feature_table(spark, sf, P, written=True))


# Tables that break one guard each: days of the next block moved over the embargo, days in two splits, a detection
# column, missing labels, and counts that include the next day.
_BROKEN = {
    "embargo": "SELECT * REPLACE (CASE WHEN date BETWEEN DATE '1999-01-01' AND DATE '1999-01-04' THEN 'train' "
               "WHEN date BETWEEN DATE '2000-07-01' AND DATE '2000-07-03' THEN 'validate' ELSE split END AS split) FROM ft",
    "one": "SELECT * FROM ft UNION ALL SELECT * REPLACE ('train' AS split) FROM ft WHERE split = 'validate' AND date < DATE '1999-02-01'",
    "forb": "SELECT *, max_mag_30d AS gap, days_since_last AS rms FROM ft",
    "train": "SELECT * FROM ft",
    "label": "SELECT * REPLACE (CASE WHEN quakes_7d = 0 THEN NULL WHEN quakes_7d = 1 THEN 2 ELSE label_7d END AS label_7d) FROM ft",
    "fwd": "SELECT * REPLACE (quakes_7d + CASE WHEN label_7d = 1 THEN 1.0 ELSE 0.0 END AS quakes_7d) FROM ft",
}


def _broken_sql():
    parts = []
    for k in _BROKEN:
        sql = _guard_sql(f"bad_{k}", **({"fitted": "median(avg_mag_7d)"} if k == "train" else {}))
        parts.append(f"SELECT * FROM ({sql[k]}) g_{k}")
    return O.with_ft("\nUNION ALL\n".join(parts), ",\n".join(f"bad_{k} AS ({v})" for k, v in _BROKEN.items()))


@query("guards_on_broken_tables", _broken_sql())
def q_guards_on_broken_tables(spark, sf):
    """G1-G5 and the forward-only guard, each on a table that breaks it: every verdict must be false."""
    from riskgrid.operators import guards as G
    from riskgrid.operators.prep import train_medians
    ft, tally = _ft_and_tally(spark, sf)
    day, split, label = F.col("date"), F.col("split"), F.col("label_7d")
    moved = (F.when(day.between(F.lit("1999-01-01"), F.lit("1999-01-04")), "train")
             .when(day.between(F.lit("2000-07-01"), F.lit("2000-07-03")), "validate").otherwise(split))
    twice = ft.where((split == "validate") & (day < F.lit("1999-02-01"))).withColumn("split", F.lit("train"))
    unclean = F.when(F.col("quakes_7d") == 0, F.lit(None)).when(F.col("quakes_7d") == 1, 2).otherwise(label).cast("int")
    whole = train_medians(ft, ["avg_mag_7d"])["avg_mag_7d"]  # a fit that saw all splits
    parts = [G.guard_embargo(ft.withColumn("split", moved)), G.guard_one_split(ft.unionByName(twice)),
             G.guard_forbidden(ft.withColumn("gap", F.col("max_mag_30d")).withColumn("rms", F.col("days_since_last"))),
             G.guard_train_only(ft, fitted=whole), G.guard_label(ft.withColumn("label_7d", unclean)),
             G.guard_forward_only(ft.withColumn("quakes_7d", F.col("quakes_7d") + F.when(label == 1, 1.0).otherwise(0.0)), tally)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("guard_embargo", O.with_ft(_G["embargo"]))
def q_guard_embargo(spark, sf):
    """G1: max(train) + 7d < min(validate); max(validate) + 7d < min(test)."""
    from riskgrid.operators.guards import guard_embargo
    return guard_embargo(feature_table(spark, sf, P, written=True))


@query("guard_one_split", O.with_ft(_G["one"]))
def q_guard_one_split(spark, sf):
    """Every (region, date) lives in exactly one split."""
    from riskgrid.operators.guards import guard_one_split
    return guard_one_split(feature_table(spark, sf, P, written=True))


@query("guard_train_only", O.with_ft(
    "SELECT g.*, round(f.train_median, 12) AS fitted_median, round(f.train_median, 12) AS train_median, "
    "round(f.full_median, 12) AS full_median FROM (" + _G["train"] + ") g, "
    "(SELECT median(avg_mag_7d) FILTER (WHERE split = 'train') AS train_median, "
    "median(avg_mag_7d) AS full_median FROM ft) f"))
def q_guard_train_only(spark, sf):
    """The fitted median is the train rows' median; those of the train rows and of all rows are reported beside it."""
    from riskgrid.operators.guards import guard_train_only
    from riskgrid.operators.prep import fit_numeric
    from riskgrid.operators.profile import exact_median
    t = feature_table(spark, sf, P, written=True)
    fitted = fit_numeric(_train(t), ["avg_mag_7d"])["avg_mag_7d"][0]
    known = t.where("avg_mag_7d IS NOT NULL").select("split", F.explode(F.array(F.lit("full"), F.when(F.col("split") == "train", F.lit("train")))).alias("part"), "avg_mag_7d")
    meds = {r["part"]: r["median"] for r in exact_median(known.where("part IS NOT NULL").select("part", "avg_mag_7d"), ["part"], "avg_mag_7d").collect()}
    lit = lambda v: F.round(F.lit(v).cast("double"), 12)
    return guard_train_only(t, fitted=fitted).select(
        "*", lit(fitted).alias("fitted_median"), lit(meds.get("train")).alias("train_median"), lit(meds.get("full")).alias("full_median"))


@query("guard_label", O.with_ft(_G["label"]))
def q_guard_label(spark, sf):
    """Label values in {0, 1}, no nulls."""
    from riskgrid.operators.guards import guard_label
    return guard_label(feature_table(spark, sf, P, written=True))


@query("guard_forward_only", O.with_ft(_G["fwd"]))
def q_guard_forward_only(spark, sf):
    """Extra guard: label re-derived from D+1..D+7 and 7-day count from D-6..D by a keyed join."""
    from riskgrid.operators.guards import guard_forward_only
    table, tally = _ft_and_tally(spark, sf)
    return guard_forward_only(table, tally)


@query("guard_report", O.with_ft("\nUNION ALL\n".join(_G[k] for k in
                                                    ("embargo", "one", "forb", "train", "label", "fwd"))))
def q_guard_report(spark, sf):
    """All guards as (check_id, guard, passed, detail) rows."""
    from riskgrid.operators.guards import guard_report
    table, tally = _ft_and_tally(spark, sf)
    return guard_report(table, tally)


# --- S1-S11 / F1-F7 / J1 / A6: ingest, catalog predicates, box join --------

from riskgrid.schema import REFERENCE_REGIONS  # noqa: E402
from riskgrid.sources import ingest as ING  # noqa: E402
from riskgrid.sources.tables import events as _events, standin_catalog as _catalog  # noqa: E402

_EV = "CAST(event_id AS VARCHAR)"


_FLAT_SQL = f"""
SELECT 'ev' || {_EV} AS id, event_type AS region, make_timestamp((epoch_us(ts) // 1000) * 1000) AS time, props AS place,
       CASE WHEN isnan(value) THEN NULL ELSE value END AS magnitude, 'ml' AS mag_type,
       CAST((event_id * 37) % 3600 AS DOUBLE) / 10 - 180 AS longitude,
       CAST((event_id * 53) % 1800 AS DOUBLE) / 10 - 90 AS latitude, value AS depth_km,
       CAST(json_extract(props, '$.k') AS INTEGER) AS nst, CAST(NULL AS DOUBLE) AS gap,
       CAST(NULL AS DOUBLE) AS dmin, CAST(NULL AS DOUBLE) AS rms, event_type AS type, 'reviewed' AS status
FROM events"""


@query("ingest_flatten", _FLAT_SQL)
def q_ingest_flatten(spark, sf):
    """Events re-shaped as feature collections (JSON), parsed with the fixed schema and flattened."""
    flat = ING.parse_collections(ING.events_as_collections(_events(spark, sf)))
    return flat.withColumn("time", F.col("time").cast("timestamp_ntz"))


_CAT_OUT = ["id", "region", "time", "magnitude", "depth_km", "longitude", "latitude", "type", "status"]


@query("ingest_landed", _FLAT_SQL)
def q_ingest_landed(spark, sf):
    """Events landed as files of multi-feature collections, cut at feature borders and flattened."""
    from riskgrid.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/riskgrid-landed/{_uuid.uuid4().hex}"
    ING.land_collections(_events(spark, sf), path)
    return ING.read_features(spark, path)


@query("scan_union", f"WITH {O.CATALOG}\nSELECT {', '.join(_CAT_OUT)} FROM catalog")
def q_scan_union(spark, sf):
    """Write the catalog as CSV, one folder per region sorted by time; scan all back with a schema."""
    from pyspark.sql import types as T

    from riskgrid.session import checkpoint_dir
    import uuid
    path = f"{checkpoint_dir(spark).rstrip('/')}/riskgrid-tables/catalog-csv-{uuid.uuid4().hex}"
    cat = _catalog(spark, sf).select(*_CAT_OUT)
    ING.write_by_region(cat, path, fmt="csv")
    schema = T.StructType([f for f in cat.schema.fields if f.name != "region"])
    back = ING.read_catalog(spark, path, schema, fmt="csv")
    ING.check_sources(back, [r.name for r in P.regions])
    return back.select(*_CAT_OUT)


@query("load_verify", f"WITH {O.CATALOG}\nSELECT region, COUNT(*) AS n FROM catalog GROUP BY ROLLUP (region)")
def q_load_verify(spark, sf):
    """Total (region null) and per-region row counts of the loaded catalog."""
    return ING.load_verify(_catalog(spark, sf))


@query("recent_snapshot", """
WITH a AS (SELECT max(ts) AS asof FROM events),
r AS (SELECT e.* FROM events e, a WHERE e.ts >= a.asof - INTERVAL 24 HOURS AND e.ts <= a.asof AND e.value >= 2.0)
SELECT COUNT(*) AS n_recent, max(ts) AS latest_ts, arg_max(event_id, ts) AS latest_event_id,
       max(value) AS max_value FROM r""")
def q_recent_snapshot(spark, sf):
    """Events of the last 24 h before the newest event, magnitude floor 2.0: count and newest row."""
    return ING.recent_snapshot(_events(spark, sf))


_JAPAN = REFERENCE_REGIONS[1]
FILTER_YEAR, FILTER_FLOOR = 1996, 150000.0


@query("catalog_filter", f"""WITH {O.CATALOG}
SELECT id, region, time, magnitude, latitude, longitude FROM catalog
WHERE magnitude >= {O._d(FILTER_FLOOR)} AND time >= TIMESTAMP '{FILTER_YEAR}-01-01'
  AND time < TIMESTAMP '{FILTER_YEAR + 1}-01-01'
  AND latitude BETWEEN {O._d(_JAPAN.min_lat)} AND {O._d(_JAPAN.max_lat)}
  AND longitude BETWEEN {O._d(_JAPAN.min_lon)} AND {O._d(_JAPAN.max_lon)}""")
def q_catalog_filter(spark, sf):
    """one year (half-open), one lat/lon box, a magnitude floor; pushed to the scan."""
    from riskgrid.operators.clean import catalog_filter
    return catalog_filter(_catalog(spark, sf), box=_JAPAN, year=FILTER_YEAR,
                          min_magnitude=FILTER_FLOOR).select("id", "region", "time", "magnitude",
                                                             "latitude", "longitude")


KEEP_TYPE = "F"


@query("clean_catalog", f"WITH {O.CATALOG}\nSELECT id, region, date, magnitude, type, lower(status) AS status "
                        f"FROM catalog WHERE type = '{KEEP_TYPE}'")
def q_clean_catalog(spark, sf):
    """keep one event type (null dropped) and lower-case the status."""
    from riskgrid.operators.clean import clean
    return clean(_catalog(spark, sf), KEEP_TYPE).select("id", "region", "date", "magnitude", "type", "status")


@query("clean_report", f"""WITH {O.CATALOG}
SELECT COUNT(*) AS rows_before, COUNT(*) FILTER (WHERE NOT COALESCE(type = '{KEEP_TYPE}', false)) AS rows_removed,
       COUNT(*) FILTER (WHERE type = '{KEEP_TYPE}') AS rows_after,
       array_to_string(list_sort(list_distinct(list(lower(status)) FILTER (WHERE type = '{KEEP_TYPE}'))), ',')
         AS statuses
FROM catalog""")
def q_clean_report(spark, sf):
    """rows before / removed / after and the sorted distinct statuses."""
    from riskgrid.operators.clean import clean_report
    return clean_report(_catalog(spark, sf), KEEP_TYPE)


@query("role_projection", f"WITH {O.CATALOG},\n{O.enriched()}\n"
                          "SELECT id, region, time, date, magnitude, depth_km, longitude, latitude, type, status, "
                          "distance_to_fault_km FROM enriched")
def q_role_projection(spark, sf):
    """only allow-listed feature and metadata columns pass."""
    from riskgrid.operators.clean import role_projection
    return role_projection(enriched_catalog(spark, sf, P))


@query("large_flag", f"WITH {O.CATALOG}\nSELECT id, region, magnitude, "
                     f"COALESCE(magnitude >= {O.threshold_case('region')}, false) AS is_large FROM catalog")
def q_large_flag(spark, sf):
    """magnitude >= the region's threshold (NaN/null not large)."""
    from riskgrid.operators.grid import with_large_flag
    return with_large_flag(_catalog(spark, sf), P.regions).select("id", "region", "magnitude", "is_large")


def _box_values():
    rows = ", ".join(f"('{r.name}', {O._d(r.min_lat)}, {O._d(r.max_lat)}, {O._d(r.min_lon)}, {O._d(r.max_lon)})"
                     for r in REFERENCE_REGIONS)
    return f"(VALUES {rows}) b(name, min_lat, max_lat, min_lon, max_lon)"


@query("box_join", f"""WITH {O.CATALOG}
SELECT c.id, c.latitude, c.longitude, b.name AS box_region FROM catalog c JOIN {_box_values()}
  ON c.latitude BETWEEN b.min_lat AND b.max_lat AND c.longitude BETWEEN b.min_lon AND b.max_lon""")
def q_box_join(spark, sf):
    """Assign each event to every region box containing it (inclusive bounds)."""
    from riskgrid.operators.spatial import box_join
    return box_join(_catalog(spark, sf), REFERENCE_REGIONS).select("id", "latitude", "longitude", "box_region")


@query("chunk_audit", f"WITH {O.CATALOG}\nSELECT region, CAST(year(time) AS INTEGER) AS year, COUNT(*) AS n, "
                      "COUNT(*) >= 20000 AS at_limit FROM catalog GROUP BY region, year(time)")
def q_chunk_audit(spark, sf):
    """Events per (region, year) and whether a yearly pull would hit the 20,000 page limit."""
    return ING.chunk_audit(_catalog(spark, sf))


# --- D1-D14: profiling --------------------------------------------------------

from riskgrid.operators import profile as PR  # noqa: E402

FLAT_THRESHOLD = 490000.0
BIG_MAGNITUDE = 495000.0
_NULL_COLS = ["quakes_7d", "avg_mag_7d", "avg_mag_30d", "max_mag_30d", "avg_depth_30d", "avg_dist_30d",
              "trend_7d", "days_since_last", "label_7d"]


@query("profile_nulls", O.with_ft("\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c != "label_7d" else "") + ") AS nulls, "
    f"CASE WHEN COUNT(*) > 0 THEN (COUNT(*) FILTER (WHERE {c} IS NULL"
    + (f" OR isnan({c})" if c != "label_7d" else "") + ")) / COUNT(*) END AS null_rate FROM feats"
    for c in _NULL_COLS)))
def q_profile_nulls(spark, sf):
    """Null share per column of the region-day features (quiet-day blanks)."""
    return PR.null_rates(_grid_feats(spark, sf), _NULL_COLS)


@query("profile_duplicates", f"""WITH {O.CATALOG}
SELECT (SELECT COUNT(*) FROM catalog) AS n_rows,
       (SELECT COUNT(*) FROM (SELECT id FROM catalog GROUP BY id HAVING COUNT(*) > 1) x) AS duplicate_ids,
       (SELECT COUNT(*) FROM (SELECT id, region, time, date, magnitude, depth_km, longitude, latitude, type, status
                               FROM catalog GROUP BY ALL HAVING COUNT(*) > 1) y) AS duplicate_rows""")
def q_profile_duplicates(spark, sf):
    """Duplicate ids and fully duplicated rows."""
    return PR.duplicates(_catalog(spark, sf))


@query("magnitude_summary", f"""WITH {O.CATALOG}
SELECT region, COUNT(*) AS n, round(median(magnitude), {ROUND}) AS median, min(magnitude) AS min,
       max(magnitude) AS max,
       AVG(CAST(magnitude >= {O.threshold_case('region')} AS DOUBLE)) AS share_large,
       AVG(CAST(magnitude >= {O._d(FLAT_THRESHOLD)} AS DOUBLE)) AS share_flat
FROM catalog GROUP BY region""")
def q_magnitude_summary(spark, sf):
    """D3: magnitude median/min/max and large shares (regional and flat threshold) by region."""
    m = PR.magnitude_summary(_catalog(spark, sf), P.regions, FLAT_THRESHOLD)
    return m.withColumn("median", F.round("median", ROUND))


@query("anomaly_counts", f"""WITH {O.CATALOG}
SELECT COUNT(*) FILTER (WHERE depth_km < 0) AS negative_depths, min(depth_km) AS min_depth,
       max(depth_km) AS max_depth, max(magnitude) AS max_magnitude,
       COUNT(*) FILTER (WHERE magnitude >= {O._d(BIG_MAGNITUDE)}) AS n_big FROM catalog""")
def q_anomaly_counts(spark, sf):
    """Negative depths, depth range, largest magnitude, count above a high mark."""
    return PR.anomaly_counts(_catalog(spark, sf), BIG_MAGNITUDE)


@query("removed_by_region", f"""WITH {O.CATALOG}
SELECT region, COUNT(*) AS rows_before,
       COUNT(*) FILTER (WHERE NOT COALESCE(type = '{KEEP_TYPE}', false)) AS rows_removed,
       COUNT(*) FILTER (WHERE COALESCE(type = '{KEEP_TYPE}', false)) AS rows_after
FROM catalog GROUP BY region""")
def q_removed_by_region(spark, sf):
    """Rows before / removed / after the type filter, by region."""
    return PR.removed_by_region(_catalog(spark, sf), KEEP_TYPE)


@query("catalog_shift", f"""WITH {O.CATALOG},
s AS (SELECT region, CAST(year(time) AS INTEGER) AS year, COUNT(*) AS n FROM catalog GROUP BY region, year(time)),
g AS (SELECT region, CAST(unnest(range(min(year), (SELECT max(year) FROM s) + 1)) AS INTEGER) AS year FROM s GROUP BY region),
y AS (SELECT g.region, g.year, COALESCE(s.n, 0) AS n FROM g LEFT JOIN s ON g.region IS NOT DISTINCT FROM s.region AND g.year = s.year)
SELECT region, year, n, prev_n, CASE WHEN prev_n > 0 THEN n / prev_n END AS ratio,
       COALESCE(CASE WHEN prev_n > 0 THEN n / prev_n END < 0.5, false) AS sharp_drop
FROM (SELECT *, LAG(n) OVER (PARTITION BY region ORDER BY year) AS prev_n FROM y) x""")
def q_catalog_shift(spark, sf):
    """Year-over-year event counts per region with sharp-drop flags."""
    return PR.catalog_shift(_catalog(spark, sf))


@query("status_mix", f"""WITH {O.CATALOG},
s AS (SELECT region, lower(status) AS status, COUNT(*) AS n FROM catalog GROUP BY region, lower(status))
SELECT region, status, n, n / SUM(n) OVER (PARTITION BY region) AS share FROM s""")
def q_status_mix(spark, sf):
    """Status counts and within-region shares."""
    return PR.status_mix(_catalog(spark, sf))


CORR_DEC = 9


@query("simpson_check", f"""WITH {O.CATALOG}
SELECT 'pooled' AS scope, COUNT(*) FILTER (WHERE magnitude + depth_km IS NOT NULL) AS n,
       round(corr(magnitude, depth_km), {CORR_DEC}) AS r FROM catalog
UNION ALL
SELECT region, COUNT(*) FILTER (WHERE magnitude + depth_km IS NOT NULL), round(corr(magnitude, depth_km), {CORR_DEC}) FROM catalog GROUP BY region""")
def q_simpson_check(spark, sf):
    """Pooled vs within-region correlation of magnitude and depth."""
    c = PR.correlations(_catalog(spark, sf), "magnitude", "depth_km")
    return c.select("scope", "n", F.round("r", CORR_DEC).alias("r"))


@query("correlation_tests", f"""WITH {O.CATALOG},
c AS (SELECT region AS scope, COUNT(*) FILTER (WHERE magnitude + depth_km IS NOT NULL) AS n, corr(magnitude, depth_km) AS r
      FROM catalog GROUP BY region
      UNION ALL SELECT 'pooled', COUNT(*) FILTER (WHERE magnitude + depth_km IS NOT NULL), corr(magnitude, depth_km) FROM catalog)
SELECT scope, n, round(r, {CORR_DEC}) AS r,
       round(CASE WHEN n > 2 AND abs(r) < 1 THEN r * sqrt((n - 2) / (1.0 - r * r)) END, 6) AS t_stat FROM c""")
def q_correlation_tests(spark, sf):
    """Correlation with n and t statistic (p-values are left to the few result rows)."""
    c = PR.correlations(_catalog(spark, sf), "magnitude", "depth_km")
    return c.select("scope", "n", F.round("r", CORR_DEC).alias("r"), F.round("t_stat", 6).alias("t_stat"))


@query("inter_event_time", f"""WITH {O.CATALOG},
g AS (SELECT region, epoch_us(time) - LAG(epoch_us(time)) OVER (PARTITION BY region ORDER BY epoch_us(time)) AS gap
      FROM catalog)
SELECT region, COUNT(gap) AS n_gaps, AVG(gap) / 3600000000.0 AS mean_gap_h,
       median(gap) / 3600000000.0 AS median_gap_h FROM g GROUP BY region""")
def q_inter_event_time(spark, sf):
    """Number of gaps, mean and exact median gap (hours) between consecutive events per region."""
    return PR.inter_event_time(_catalog(spark, sf))


@query("surge_ratio", O.with_ft("""
SELECT region, max(ratio) AS max_surge, arg_min(date, (-ratio, date)) AS surge_date FROM (
  SELECT region, date, CASE WHEN prior > 0 THEN (n * 30.0) / prior END AS ratio FROM (
    SELECT region, date, COALESCE(n, 0) AS n,
           SUM(COALESCE(n, 0)) OVER (PARTITION BY region ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)
             AS prior FROM filled) a) b
WHERE ratio IS NOT NULL GROUP BY region"""))
def q_surge_ratio(spark, sf):
    """Largest day count relative to the previous 30-day mean, per region."""
    from riskgrid.plans.feature_table import stored_region_days
    return PR.surge(stored_region_days(spark, sf, P))


@query("seasonality", f"""WITH {O.CATALOG},
m AS (SELECT region, CAST(month(time) AS INTEGER) AS month, CAST(year(time) AS INTEGER) AS year, COUNT(*) AS n
      FROM catalog GROUP BY ALL),
mo AS (SELECT region, month, CAST(SUM(n) AS BIGINT) AS n FROM m GROUP BY region, month),
mo2 AS (SELECT *, SUM(n) OVER (PARTITION BY region) / 12.0 AS e FROM mo),
chi AS (SELECT region, round(SUM((n - e) * (n - e) / e) + (12 - COUNT(*)) * max(e), 9) AS chi2, COUNT(*) AS months_seen,
               arg_min(month, (-n, month)) AS top_month, max(n) AS top_month_n FROM mo2 GROUP BY region),
ty AS (SELECT m.region, arg_min(year, (-n, year)) AS top_year, max(n) AS top_year_n
       FROM m JOIN chi ON m.region = chi.region AND m.month = chi.top_month GROUP BY m.region)
SELECT chi.*, ty.top_year, ty.top_year_n FROM chi JOIN ty USING (region)""")
def q_seasonality(spark, sf):
    """Month-profile chi-square per region, the top month and the year dominating it."""
    s = PR.seasonality(_catalog(spark, sf))
    return s.withColumn("chi2", F.round("chi2", 9)).select(
        "region", "chi2", "months_seen", "top_month", "top_month_n", "top_year", "top_year_n")


@query("threshold_compare", f"""WITH {O.CATALOG},
{O.enriched()},
{O.tally()},
{O.grid()},
t2 AS (SELECT region, date, COUNT(*) FILTER (WHERE magnitude >= {O._d(FLAT_THRESHOLD)}) AS large_flat
       FROM catalog GROUP BY region, date),
f2 AS (SELECT f.region, f.date, f.large, t2.large_flat FROM filled f LEFT JOIN t2 USING (region, date)),
l AS (SELECT region,
        CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(COALESCE(large, 0)) OVER w >= 1 AS DOUBLE) END AS l_regional,
        CASE WHEN COUNT(*) OVER w = 7 THEN CAST(SUM(COALESCE(large_flat, 0)) OVER w >= 1 AS DOUBLE) END AS l_flat
      FROM f2 WINDOW w AS (PARTITION BY region ORDER BY date ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING))
SELECT region, AVG(l_regional) AS rate_regional, AVG(l_flat) AS rate_flat, COUNT(l_regional) AS n
FROM l GROUP BY region""")
def q_threshold_compare(spark, sf):
    """7-day positive rate with regional thresholds vs one flat threshold."""
    from riskgrid.operators.grid import daily_grid, gap_filled_tally, large_flag
    from riskgrid.session import materialize
    cat = _catalog(spark, sf)
    # One pass: both large counts per (region, day) in the same aggregate.
    tally = cat.groupBy("region", "date").agg(
        F.count_if(large_flag(F.col("region"), F.col("magnitude"), P.regions)).alias("large"),
        F.count_if(F.coalesce(F.col("magnitude") >= F.lit(FLAT_THRESHOLD), F.lit(False))).alias("large_flat"))
    tally = materialize(tally, "tally_two_thresholds")
    return PR.threshold_compare(gap_filled_tally(daily_grid(spark, tally, P.regions), tally))


@query("spatial_bins", f"""WITH {O.CATALOG}
SELECT floor(latitude / 10.0) * 10.0 AS lat_bin, floor(longitude / 10.0) * 10.0 AS lon_bin, COUNT(*) AS n
FROM catalog GROUP BY ALL""")
def q_spatial_bins(spark, sf):
    """Event counts on a 10-degree lat/lon grid."""
    return PR.spatial_bins(_catalog(spark, sf)).select(
        F.col("lat_bin").cast("double").alias("lat_bin"), F.col("lon_bin").cast("double").alias("lon_bin"), "n")


# --- M1, M2, M5-M9, E10, X3: model fits (rows-only checks; no SQL oracle) ----

CHOSEN_VARIANT = "depth"


def _model_table(spark, sf):
    return feature_table(spark, sf, P, written=True)


@query("logreg_scores")
def q_logreg_scores(spark, sf):
    """M1: weighted L2 logistic regression (chosen variant) scores on train + validate."""
    from riskgrid.plans import models as M
    scored, _ = M.ablation(_model_table(spark, sf), [CHOSEN_VARIANT], "logreg")
    return scored


@query("rf_scores")
def q_rf_scores(spark, sf):
    """M2: balanced random forest (300 trees, min 20 per leaf) scores on train + validate."""
    from riskgrid.plans import models as M
    scored, _ = M.ablation(_model_table(spark, sf), [CHOSEN_VARIANT], "forest")
    return scored


@query("gbt_scores")
def q_gbt_scores(spark, sf):
    """Gradient-boosted trees on the same design, scores on train + validate."""
    from riskgrid.plans import models as M
    scored, _ = M.ablation(_model_table(spark, sf), [CHOSEN_VARIANT], "gbt")
    return scored


@query("per_region_scores")
def q_per_region_scores(spark, sf):
    """M5: one logistic regression per (region, variant); validation metrics per run."""
    from riskgrid.plans import models as M
    from riskgrid.session import materialize
    scored, _ = M.per_region(_model_table(spark, sf), [r.name for r in P.regions])
    m = M.evaluate(materialize(scored, "per_region_scores"))
    return m.filter(F.col("region").isNull() & (F.col("split") == "validate")).select(
        F.split("run", r"\|")[0].alias("region"), F.split("run", r"\|")[1].alias("variant"), "metric", "value")


@query("best_variant_per_region")
def q_best_variant_per_region(spark, sf):
    """M5 + E8: best variant per region by validation AP of the per-region models."""
    from riskgrid.operators.metrics import best_per_region
    m = q_per_region_scores(spark, sf).filter(F.col("metric") == "ap")
    return best_per_region(m.select(F.col("variant").alias("run"), "region", F.lit("validate").alias("split"),
                                    "metric", "value"))


@query("interaction_scores")
def q_interaction_scores(spark, sf):
    """M6: region x distance and region x (distance, activity) interaction models; metric rows."""
    from riskgrid.plans import models as M
    from riskgrid.session import materialize
    scored, _ = M.interaction_runs(_model_table(spark, sf), [r.name for r in P.regions])
    return M.evaluate(materialize(scored, "interaction_scores"))


@query("ablation")
def q_ablation(spark, sf):
    """M9 + E9: five pooled variants, leaderboard on validation (AP, F1, log-loss, per-region AP)."""
    from riskgrid.operators.metrics import leaderboard
    from riskgrid.plans import models as M
    from riskgrid.session import materialize
    scored, _ = M.ablation(_model_table(spark, sf))
    return leaderboard(M.evaluate(materialize(scored, "ablation_scores")), [r.name for r in P.regions])


@query("rf_overfit_gap")
def q_rf_overfit_gap(spark, sf):
    """E7 on the forest: train AP minus validation AP."""
    from riskgrid.operators.metrics import overfit_gap
    from riskgrid.plans import models as M
    scored, _ = M.ablation(_model_table(spark, sf), [CHOSEN_VARIANT], "forest")
    return overfit_gap(M.evaluate(scored))


@query("coefficients")
def q_coefficients(spark, sf):
    """M7: standardized LR coefficients of the chosen variant, by absolute size."""
    from riskgrid.plans import models as M
    _, fitted = M.ablation(_model_table(spark, sf), [CHOSEN_VARIANT], "logreg")
    return M.coefficients(spark, fitted[0])


@query("importances")
def q_importances(spark, sf):
    """M8: forest Gini importances of the chosen variant, descending."""
    from riskgrid.plans import models as M
    _, fitted = M.ablation(_model_table(spark, sf), [CHOSEN_VARIANT], "forest")
    return M.importances(spark, fitted[0])


@query("run_log")
def q_run_log(spark, sf):
    """Params + train_/val_ metric rows for the LR ablation (append-ready)."""
    from riskgrid.plans import models as M
    scored, fitted = M.ablation(_model_table(spark, sf))
    return M.run_log(M.evaluate(scored), fitted)


# --- Streaming form of the tally (section 7.4) -------------------------------

_STREAM_COLS = ["region", "date", "n", "mag_sum", "mag_max", "large", "depth_sum", "lat_sum", "lon_sum"]


@query("streaming_tally", f"WITH {O.CATALOG},\n{O.tally(source='(SELECT *, NULL::DOUBLE AS distance_to_fault_km FROM catalog)')}\n"
                          f"SELECT {', '.join(_STREAM_COLS)} FROM tally")
def q_streaming_tally(spark, sf):
    """Structured Streaming: landed files -> watermark -> 1-day windows (update mode) ->
    foreachBatch changelog -> newest row per key; equals the batch tally."""
    from riskgrid.streaming import tally as ST
    cat = _catalog(spark, sf).select("id", "region", "time", "magnitude", "depth_km", "latitude", "longitude")
    src, log, state = ST.scratch(spark, "src"), ST.scratch(spark, "changelog"), ST.scratch(spark, "state")
    ST.land_in_time_order(cat, src, unit="year")
    # Yearly slices: files inside one slice arrive in any order, so the delay covers a slice.
    ST.run_to_changelog(spark, src, cat.schema, P.regions, log, state, watermark="400 days")
    return ST.current_tally(spark, log).select(*_STREAM_COLS)


# --- Planned in the reference docs: X1, X2, X4, X5, X8, X9, X11 --

import datetime as _dt  # noqa: E402

from riskgrid.operators import planned as PL  # noqa: E402


def _filled(spark, sf):
    from riskgrid.plans.feature_table import stored_region_days
    return stored_region_days(spark, sf, P)


def _long_sql():
    w = "PARTITION BY region ORDER BY date"
    cols = []
    for y in (1, 3, 5):
        k = 365 * y
        n = f"(cn - COALESCE(LAG(cn, {k}) OVER ({w}), 0))"
        s = f"(cs - COALESCE(LAG(cs, {k}) OVER ({w}), 0))"
        cols.append(f"CASE WHEN {n} <> 0 THEN CAST({s} AS DOUBLE) / CAST({n} AS DOUBLE) / 1000000.0 END "
                    f"AS avg_mag_{y}y")
    run = f"OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return O.with_ft(f"SELECT region, date, max_mag_all, {', '.join(cols)} FROM r",
                     f"r AS (SELECT region, date, SUM(COALESCE(n, 0)) {run} AS cn, "
                     f"SUM(COALESCE(mag_sum, 0)) {run} AS cs, MAX(mag_max) {run} AS max_mag_all FROM filled)")


@query("long_windows", _long_sql())
def q_long_windows(spark, sf):
    """1/3/5-year mean magnitude (prefix-sum differences) and all-time max per region-day."""
    return PL.long_windows(_filled(spark, sf))


def _val_activity(spark, sf):
    from riskgrid.plans.scoring import activity_scores
    t = feature_table(spark, sf, P, written=True)
    return activity_scores(t.filter(F.col("split") == "validate"))


_ACT = "quakes_7d / (quakes_7d + CAST(10.0 AS DOUBLE))"


@query("region_thresholds", O.with_ft("""
SELECT run, region, arg_max(score, (f1, score)) AS threshold, max(f1) AS f1 FROM (
  SELECT run, region, score, (2 * tp) / (tp + fp + P) AS f1 FROM (
    SELECT run, region, score,
           SUM(pos) OVER (PARTITION BY run, region ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS tp,
           SUM(neg) OVER (PARTITION BY run, region ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS fp,
           SUM(pos) OVER (PARTITION BY run, region) AS P
    FROM (SELECT 'activity' AS run, region, """ + _ACT + """ AS score,
                 COUNT(*) FILTER (WHERE label_7d = 1) AS pos, COUNT(*) FILTER (WHERE label_7d = 0) AS neg
          FROM ft WHERE split = 'validate' GROUP BY ALL) d) c WHERE P > 0) x
GROUP BY run, region"""))
def q_region_thresholds(spark, sf):
    """Per-region alarm threshold maximizing validation F1 (closed-form activity score)."""
    return PL.best_thresholds(_val_activity(spark, sf))


@query("asof_refresh", O.with_ft(
    "SELECT " + ", ".join(["region", "date"] + list(FEATURE_COLUMNS))
    + " FROM feats WHERE date = (SELECT max(date) FROM feats)"))
def q_asof_refresh(spark, sf):
    """The newest region-day of each region with its features (the rows a refresh scores)."""
    return PL.asof_rows(_grid_feats(spark, sf)).select("region", "date", *FEATURE_COLUMNS)


# The last fold's year ends before the sealed test block and its embargo.
_CUTOFFS = [_dt.date(1996, 12, 31), _dt.date(1997, 12, 31), _dt.date(1998, 12, 31)]


def _expanding_sql():
    from riskgrid.schema import SplitSpec
    parts = []
    for end in _CUTOFFS:
        ve = end + _dt.timedelta(days=365)
        spec = SplitSpec(end, end + _dt.timedelta(days=1), ve, ve + _dt.timedelta(days=1), 7)
        parts.append(f"SELECT DATE '{end}' AS train_end, split, COUNT(*) AS rows FROM "
                     f"(SELECT {O.split_case('date', spec)} AS split FROM feats WHERE label_7d IS NOT NULL) s "
                     "WHERE split IS NOT NULL GROUP BY split")
    return O.with_ft("\nUNION ALL\n".join(parts))


@query("expanding_splits", _expanding_sql())
def q_expanding_splits(spark, sf):
    """Split sizes for an expanding list of train cutoffs (1-year validation, 7-day embargo)."""
    from riskgrid.operators.split import drop_unobservable
    return PL.expanding_splits(drop_unobservable(_grid_feats(spark, sf)), _CUTOFFS, 365)


@query("calibration", O.with_ft(f"""
SELECT 'activity' AS run, CAST(LEAST(floor(s * 10), 9) AS INTEGER) AS bin, COUNT(*) AS n,
       round(AVG(s), {ROUND}) AS mean_score, AVG(CAST(label_7d AS DOUBLE)) AS observed_rate
FROM (SELECT {_ACT} AS s, label_7d FROM ft WHERE split = 'validate') x GROUP BY ALL"""))
def q_calibration(spark, sf):
    """Ten equal-width score bins: mean score vs observed positive rate."""
    c = PL.calibration(_val_activity(spark, sf))
    return c.withColumn("mean_score", F.round("mean_score", ROUND))


@query("risk_tiers", O.with_ft(f"""
SELECT 'activity' AS run, f.region,
       CASE WHEN s >= b.base_rate * 2.0 THEN 'high' WHEN s >= b.base_rate * 1.0 THEN 'elevated' ELSE 'low' END
         AS tier, COUNT(*) AS n, AVG(CAST(label_7d AS DOUBLE)) AS observed_rate
FROM (SELECT region, {_ACT} AS s, label_7d FROM ft WHERE split = 'validate') f
JOIN (SELECT region, AVG(CAST(label_7d AS DOUBLE)) AS base_rate FROM ft WHERE split = 'train' GROUP BY region) b
  USING (region)
GROUP BY ALL"""))
def q_risk_tiers(spark, sf):
    """Low / elevated / high tiers relative to each region's train base rate."""
    t = feature_table(spark, sf, P, written=True)
    base = t.filter(F.col("split") == "train").groupBy("region").agg(
        F.avg(F.col("label_7d").cast("double")).alias("base_rate"))
    return PL.risk_tiers(_val_activity(spark, sf), base)


@query("other_types_30d", f"""WITH {O.CATALOG},
{O.enriched()},
{O.tally()},
{O.grid()},
o AS (SELECT region, date, COUNT(*) AS n_other FROM catalog
      WHERE NOT COALESCE(type = '{KEEP_TYPE}', false) GROUP BY region, date)
SELECT g.region, g.date, CAST(SUM(COALESCE(o.n_other, 0)) OVER (PARTITION BY g.region ORDER BY g.date
         ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS BIGINT) AS other_30d
FROM grid g LEFT JOIN o USING (region, date)""")
def q_other_types_30d(spark, sf):
    """X11: trailing 30-day count of the event types the cleaning step removes (a covariate)."""
    from pyspark.sql import Window
    from riskgrid.operators.grid import daily_grid
    from riskgrid.plans.feature_table import stored_tally
    cat = _catalog(spark, sf)
    # The calendar comes from the stored tally (same catalog rows); one pass for the counts.
    grid = daily_grid(spark, stored_tally(spark, sf, P), P.regions)
    other = PL.other_type_counts(cat, KEEP_TYPE)
    w = Window.partitionBy("region").orderBy("date").rowsBetween(-29, 0)
    return grid.join(other, ["region", "date"], "left").select(
        "region", "date", F.sum(F.coalesce("n_other", F.lit(0))).over(w).cast("bigint").alias("other_30d"))


#: Boundary map of the stand-in: one short segment per customer, all around the globe, poles and date line included.
_MAP_SQL = """seg AS (
  SELECT x1, y1, x1 + (c_custkey * 29 % 41) / 8.0 - 2.5 AS x2, greatest(-90.0, least(90.0, y1 + (c_custkey * 31 % 37) / 9.0 - 2.0)) AS y2
  FROM (SELECT c_custkey, CAST((c_custkey * 7919) % 3600 AS DOUBLE) / 10 - 180 AS x1,
               CAST((c_custkey * 104729) % 1801 AS DOUBLE) / 10 - 90 AS y1 FROM customer) c)"""


def _boundary_map(spark, sf):
    from riskgrid.sources.tables import read_table
    key = F.col("c_custkey")
    start = read_table(spark, sf, "customer").select(key, ((key * 7919) % 3600).cast("double").alias("a"), ((key * 104729) % 1801).cast("double").alias("b"))
    start = start.select(key, (F.col("a") / 10 - 180).alias("x1"), (F.col("b") / 10 - 90).alias("y1"))
    y2 = F.col("y1") + (key * 31 % 37) / 9.0 - 2.0
    return start.select("x1", "y1", (F.col("x1") + (key * 29 % 41) / 8.0 - 2.5).alias("x2"), F.greatest(F.lit(-90.0), F.least(F.lit(90.0), y2)).alias("y2"))


def _gc_sql(segments):
    return f"""WITH {O.CATALOG},
{segments},
near AS (SELECT longitude, latitude, min({O.arc_sql('longitude', 'latitude')}) AS km
         FROM (SELECT DISTINCT longitude, latitude FROM catalog) p CROSS JOIN seg GROUP BY ALL)
SELECT id, latitude, longitude, round(km, 4) AS geodesic_km FROM catalog JOIN near USING (longitude, latitude)"""


@query("geodesic_distance", _gc_sql(O.segment_values()))
def q_geodesic_distance(spark, sf):
    """Great-circle km from every event to its nearest boundary segment."""
    g = PL.geodesic_distance_to_fault(_catalog(spark, sf), P.segments)
    return g.select("id", "latitude", "longitude", F.round("geodesic_km", 4).alias("geodesic_km"))


@query("geodesic_distance_map", _gc_sql(_MAP_SQL))
def q_geodesic_distance_map(spark, sf):
    """The same for a map with a segment per customer."""
    from riskgrid.operators.sphere import nearest_segment_km
    g = nearest_segment_km(_catalog(spark, sf), _boundary_map(spark, sf))
    return g.select("id", "latitude", "longitude", F.round("geodesic_km", 4).alias("geodesic_km"))


@query("drift_check", O.with_ft(f"""
SELECT y.region, y.year, y.n, y.ratio, round(a.ap, {ROUND}) AS ap, round(a.ap_prev, {ROUND}) AS ap_prev,
       COALESCE(y.ratio < 0.5, false) OR COALESCE(a.ap_prev - a.ap > 0.1, false) AS drift
FROM (SELECT region, year, n, CASE WHEN prev_n > 0 THEN n / prev_n END AS ratio FROM (
        SELECT *, LAG(n) OVER (PARTITION BY region ORDER BY year) AS prev_n FROM (
          SELECT region, CAST(year(time) AS INTEGER) AS year, COUNT(*) AS n FROM catalog GROUP BY ALL) c) d) y
LEFT JOIN (SELECT region, year, ap, LAG(ap) OVER (PARTITION BY region ORDER BY year) AS ap_prev FROM
   {O.ap_sql("(SELECT region, CAST(year(date) AS INTEGER) AS year, large_30d AS score, label_7d AS label FROM ft)",
             "region, year")} q) a USING (region, year)"""))
def q_drift_check(spark, sf):
    """Yearly count ratio (D6) with the yearly AP of the persistence scorer; drift flags."""
    from riskgrid.operators.profile import catalog_shift
    t = feature_table(spark, sf, P, written=True)
    scored = t.select("region", F.year("date").alias("year"), F.col("large_30d").alias("score"),
                      F.col("label_7d").alias("label"))
    counts = catalog_shift(_catalog(spark, sf)).select("region", "year", "n", "ratio")
    d = PL.drift_flags(scored, counts)
    return d.select("region", "year", "n", "ratio", F.round("ap", ROUND).alias("ap"),
                    F.round("ap_prev", ROUND).alias("ap_prev"), "drift")


@query("inter_event_time_events", """
WITH g AS (SELECT event_type AS region,
                  epoch_us(ts) - LAG(epoch_us(ts)) OVER (PARTITION BY event_type ORDER BY epoch_us(ts)) AS gap
           FROM events)
SELECT region, COUNT(gap) AS n_gaps, AVG(gap) / 3600000000.0 AS mean_gap_h,
       median(gap) / 3600000000.0 AS median_gap_h FROM g GROUP BY region""")
def q_inter_event_time_events(spark, sf):
    """D10 on the events stream (microsecond timestamps): gaps per event type."""
    ev = _events(spark, sf).select(F.col("event_type").alias("region"), F.col("ts").alias("time"))
    return PR.inter_event_time(ev)


@query("shuffled_split_control")
def q_shuffled_split_control(spark, sf):
    """The chosen LR evaluated under the embargoed date split and under a hashed
    (shuffled) split of the same region-days; the gap shows what shuffling leaks."""
    from riskgrid.plans import models as M
    t = PL.before_test(feature_table(spark, sf, P, written=True), P.split)
    out = []
    for kind, table in (("date", t), ("shuffled", PL.hashed_split(t))):
        scored, _ = M.ablation(table, [CHOSEN_VARIANT])
        m = M.evaluate(scored).filter(F.col("region").isNull() & (F.col("metric") == "ap"))
        out.append(m.select(F.lit(kind).alias("split_kind"), "split", "value"))
    return out[0].unionByName(out[1])


@query("expanding_retrain")
def q_expanding_retrain(spark, sf):
    """Retrain the chosen LR at each expanding cutoff; AP on the following year."""
    from riskgrid.operators.split import split_of
    from riskgrid.plans import models as M
    from riskgrid.schema import SplitSpec
    base = PL.before_test(feature_table(spark, sf, P, written=True), P.split).drop("split")
    parts = []
    for end in _CUTOFFS:
        ve = end + _dt.timedelta(days=365)
        spec = SplitSpec(end, end + _dt.timedelta(days=1), ve, ve + _dt.timedelta(days=1), P.horizon)
        t = base.withColumn("split", split_of(F.col("date"), spec)).filter(F.col("split").isNotNull())
        scored, _ = M.ablation(t, [CHOSEN_VARIANT])
        m = M.evaluate(scored).filter(F.col("region").isNull() & (F.col("metric") == "ap"))
        parts.append(m.select(F.lit(end).alias("train_end"), "split", "value"))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@query("sealed_days_used", "SELECT CAST(NULL AS VARCHAR) AS used_by, CAST(NULL AS VARCHAR) AS region, CAST(NULL AS DATE) AS date WHERE false")
def q_sealed_days_used(spark, sf):
    """Days of the test block that a fold or the shuffled control would read. There must be none."""
    from riskgrid.operators.split import split_of
    from riskgrid.schema import SplitSpec
    t = PL.before_test(feature_table(spark, sf, P, written=True), P.split)
    used = [PL.hashed_split(t).where("split IS NOT NULL").select(F.lit("shuffled control").alias("used_by"), "region", "date")]
    for end in _CUTOFFS:
        ve = end + _dt.timedelta(days=365)
        fold = split_of(F.col("date"), SplitSpec(end, end + _dt.timedelta(days=1), ve, ve + _dt.timedelta(days=1), P.horizon))
        used.append(feature_table(spark, sf, P, written=True).where(fold.isin("train", "validate")).select(F.lit(f"fold {end}").alias("used_by"), "region", "date"))
    out = used[0]
    for u in used[1:]:
        out = out.unionByName(u)
    # A day's label reads the horizon behind it.
    return out.where(F.date_add("date", P.horizon) >= F.lit(P.split.test_start))


@query("model_comparison")
def q_model_comparison(spark, sf):
    """The published comparison table's shape: no-skill prior, persistence heuristic, the five
    pooled LR variants and the forest, one validation row each (AP, F1, log-loss, per-region AP)."""
    from riskgrid.operators.metrics import leaderboard
    from riskgrid.plans import models as M
    from riskgrid.plans.scoring import closed_form_metrics
    from riskgrid.session import materialize
    t = feature_table(spark, sf, P, written=True)
    lr, _ = M.ablation(t)
    rf, _ = M.ablation(t, [CHOSEN_VARIANT], "forest")
    fitted = M.evaluate(materialize(lr.unionByName(rf), "comparison_scores"))
    closed = closed_form_metrics(t).filter(F.col("run") != "activity")
    return leaderboard(fitted.unionByName(closed), [r.name for r in P.regions])


from riskgrid.plans import model_queries  # noqa: E402, F401  (registers its queries)
