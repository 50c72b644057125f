"""Training rows of one class only, as dense catalogs give them: fits are that class, nothing fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskgrid.plans import models as M
from riskgrid.schema import BASE_NUMERIC, FEATURE_COLUMNS


def days(spark, labels):
    """100 train and 20 validate days a region; ``labels``: region -> label of its i-th day."""
    rows = [(r, dt.date(1998, 1, 1) + dt.timedelta(days=i), "train" if i < 100 else "validate", label(i),
             *[float((i * (j + 3)) % 17) for j in range(len(FEATURE_COLUMNS))]) for r, label in labels.items() for i in range(120)]
    return spark.createDataFrame(rows, "region string, date date, split string, label_7d int, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS))


@pytest.mark.parametrize("kind", ["logreg", "forest", "gbt"])
@pytest.mark.parametrize("only", [0, 1])
def test_fits_on_one_class_score_that_class(spark, kind, only):
    table = days(spark, {"A": lambda i: only, "B": lambda i: only})
    more = {"forest": (3,), "gbt": (2, 2)}.get(kind, ())
    m = M.FITTERS[kind](table.where("split = 'train'"), list(BASE_NUMERIC), ["region"], f"{kind}_base", *more)
    rows = M.score_splits(m, table).collect()
    assert len(rows) == 240
    assert all(r["pred"] == only and 0.0 <= r["score"] <= 1.0 and (kind == "gbt" or r["score"] == only) for r in rows)


@pytest.mark.parametrize("only", [0, 1])
def test_a_region_of_one_class_beside_one_of_two(spark, only):
    table = days(spark, {"A": lambda i: only, "B": lambda i: int(i * 7 % 5 < 2)})
    scored, fitted = M.per_region(table, ["A", "B"], ["base", "depth"])
    got = {(r["run"], r["region"], r["n"]) for r in scored.groupBy("run", "region").agg(F.count("score").alias("n")).collect()}
    assert got == {(f"{r}|{v}", r, 120) for r in "AB" for v in ("base", "depth")}
    checked = M.certificates([(table.where(F.col("region") == r), [m for m in fitted if m.run[0] == r]) for r in "AB"]).collect()
    assert len(checked) == 8 and all(r["residual_ok"] for r in checked)
    assert {r["run"] for r in M.run_log(M.evaluate(scored), fitted).collect()} == {m.run for m in fitted}


def test_a_stored_model_of_one_class_loads_again(spark, tmp_path):
    from riskgrid.plans.model_store import load_model, save_model
    table = days(spark, {"A": lambda i: 0})
    m = M.fit_logreg(table.where("split = 'train'"), list(BASE_NUMERIC), ["region"], "logreg_base")
    save_model(m, table, str(tmp_path), dt.datetime(2001, 8, 2))
    assert {r["score"] for r in load_model(spark, str(tmp_path), m.run).score(table).collect()} == {0.0}


def test_no_train_rows_are_refused(spark):
    with pytest.raises(ValueError):
        M.balanced(days(spark, {"A": lambda i: 0}).where("split = 'test'"))
