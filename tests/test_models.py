"""Model layer: LR parity with the reference objective, forest sanity, rankings."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01


@pytest.fixture(scope="module")
def table(spark):
    from riskgrid.plans.feature_table import feature_table
    from riskgrid.schema import PipelineParams
    return feature_table(spark, SF01, PipelineParams(), written=True).cache()


def newton(X, y, w, C=1.0):
    """Optimum of C * sum(w * logloss) + 0.5 * |beta|^2 (intercept not penalized)."""
    Xa = np.hstack([X, np.ones((len(X), 1))])
    beta = np.zeros(Xa.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-Xa @ beta))
        g = C * Xa.T @ (w * (p - y))
        g[:-1] += beta[:-1]
        H = C * (Xa * (w * p * (1 - p))[:, None]).T @ Xa
        H[np.arange(len(beta) - 1), np.arange(len(beta) - 1)] += 1
        step = np.linalg.solve(H, g)
        beta -= step
        if np.abs(step).max() < 1e-14:
            break
    return beta


def test_logreg_matches_newton_optimum(spark, table):
    from riskgrid.operators.prep import transform
    from riskgrid.schema import VARIANTS
    from riskgrid.plans import models as M
    train = table.filter(F.col("split") == "train")
    num, cat = VARIANTS["depth"].columns()
    m = M.fit_logreg(train, num, cat, "t")
    tw, n = M.balanced(train)
    pdf = transform(tw, num, m.categories, m.stats, keep=("label_7d", "weight")).toPandas()
    beta = newton(pdf[m.names].to_numpy(), pdf["label_7d"].to_numpy(float), pdf["weight"].to_numpy())
    got = np.append(m.model.coefficients.toArray(), m.model.intercept)
    assert np.abs(got - beta).max() < 1e-5
    # Balanced weights sum to n.
    assert pdf["weight"].sum() == pytest.approx(n)


def test_scores_and_rule(spark, table):
    from riskgrid.plans import models as M
    scored, fitted = M.ablation(table, ["base"])
    rows = scored.collect()
    assert {r["split"] for r in rows} == {"train", "validate"}  # test stays sealed
    assert all((r["score"] >= 0.5) == (r["pred"] == 1) for r in rows)
    coefs = M.coefficients(spark, fitted[0]).collect()
    assert len(coefs) == 8 + 5
    assert [abs(r["coefficient"]) for r in coefs] == sorted((abs(r["coefficient"]) for r in coefs), reverse=True)


def test_forest_quality_and_importances(spark, table):
    from riskgrid.plans import models as M
    scored, fitted = M.ablation(table, ["depth"], "forest")
    m = {(r["split"], r["metric"]): r["value"] for r in M.evaluate(scored).filter("region is null").collect()}
    assert m[("train", "ap")] > m[("validate", "ap")] > 0.0
    imp = M.importances(spark, fitted[0]).collect()
    assert sum(r["importance"] for r in imp) == pytest.approx(1.0)


def test_hashed_split_assigns_every_row(spark, table):
    from riskgrid.operators.planned import hashed_split
    h = hashed_split(table)
    counts = {r["split"]: r["count"] for r in h.groupBy("split").count().collect()}
    assert set(counts) == {"train", "validate", "test"}
    assert sum(counts.values()) == table.count()
    assert counts["train"] > counts["validate"] > 0
