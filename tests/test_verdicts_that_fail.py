"""Guards that must say false, medians judged by ranks, folds and the run log."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from riskgrid.operators import guards as G
from riskgrid.operators import profile
from riskgrid.plans import models as M
from riskgrid.plans.feature_table import feature_table, stored_tally
from riskgrid.plans.queries import QUERIES
from riskgrid.plans.search import Config, folded, search
from riskgrid.schema import STANDIN_SPLIT


@pytest.fixture(scope="module")
def table(spark):
    return feature_table(spark, SF001, written=True)


def test_every_guard_fails_on_the_table_that_breaks_it(spark):
    rows = QUERIES["guards_on_broken_tables"](spark, SF001).collect()
    assert sorted(r["check_id"] for r in rows) == [1, 2, 3, 4, 5, 6, 7] and not any(r["passed"] for r in rows)
    assert "excluded columns in use: gap, rms" in [r["detail"] for r in rows]


def test_guards_on_an_empty_table(spark, table):
    empty = table.limit(0)
    assert not G.guard_one_split(empty).first()["passed"]
    assert not any(r["passed"] for r in G.guard_embargo(empty).collect())
    assert G.guard_forbidden(empty.withColumn("gap", F.lit(1.0))).first()["passed"]  # no row holds a value
    assert not G.median_ranks(empty, "avg_mag_7d", 1.0).first()[0]


def test_all_guards_pass_on_the_table_itself(spark, table):
    assert all(r["passed"] for r in G.guard_report(table, stored_tally(spark, SF001)).collect())


def test_median_by_ranks(spark):
    rnd = random.Random(7)
    for n in (1, 2, 3, 4, 9, 10, 25):
        for _ in range(2):
            values = [float(rnd.randint(0, 6)) for _ in range(n)]
            rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
            middle = statistics.median(values)
            for v in {middle, middle + 0.5, middle - 0.5, middle + 1, *values}:
                assert G.median_ranks(rows, "x", v).first()[0] == (v == middle), (values, v)


def test_duplicates_among_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "d"), (None, "e"), (3, None), (3, None)]
    got = profile.duplicates(spark.createDataFrame(rows, "id int, v string")).first()
    assert (got["n_rows"], got["duplicate_rows"]) == (9, 3)


def test_folds_hold_no_sealed_day_and_labels_do_not_cross(table):
    ends = [dt.date(1998, 12, 31), dt.date(2000, 3, 31)]  # the second would reach into the test block
    for end in ends:
        rows = folded(table, STANDIN_SPLIT, end, 365)
        a = rows.groupBy("split").agg(F.min("date").alias("lo"), F.max("date").alias("hi")).collect()
        at = {r["split"]: r for r in a}
        assert at["train"]["hi"] + dt.timedelta(days=7) < at["validate"]["lo"]
        assert at["validate"]["hi"] + dt.timedelta(days=7) < STANDIN_SPLIT.test_start


def test_search_chooses_the_highest_mean(spark, table):
    grid = (Config("logreg", "base", (1.0,)), Config("logreg", "latlon_only", (0.001,)))
    scores, ranking = search(table, STANDIN_SPLIT, [dt.date(1997, 6, 30), dt.date(1998, 6, 30)], 200, grid)
    rows = ranking.collect()
    mean = {r["config"]: r["mean_ap"] for r in rows}
    assert len(rows) == 4 and {r["config"] for r in rows if r["chosen"]} == {max(mean, key=mean.get)}
    for c in mean:
        assert mean[c] == pytest.approx(statistics.mean(r["ap"] for r in rows if r["config"] == c))
    assert scores.groupBy("config", "train_end").count().select("count").distinct().count() <= 2


def test_run_log_appends_replaces_only_itself_and_drifts(spark, table, tmp_path):
    path = str(tmp_path / "runs")

    def log(value):
        return spark.createDataFrame([("r", {"C": "1"}, "validate", None, m, f"val_{m}", v) for m, v in (("ap", value), ("log_loss", 1 - value))],
                                     "run string, params map<string,string>, split string, region string, metric string, name string, value double")
    M.append_runs(log(0.5), path, "one", dt.datetime(2001, 1, 1))
    M.append_runs(log(0.9), path, "two", dt.datetime(2001, 1, 8))
    M.append_runs(log(0.8), path, "two", dt.datetime(2001, 1, 8))
    M.append_runs(log(0.6), path, "three", dt.datetime(2001, 1, 15))
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    last = {r["metric"]: r for r in M.drift(stored).collect()}
    assert (last["ap"]["previous"], last["ap"]["current"], last["ap"]["drift"]) == (0.8, 0.6, True) and last["log_loss"]["drift"]
    earlier = {r["metric"]: r for r in M.drift(stored, as_of=dt.datetime(2001, 1, 10)).collect()}
    assert (earlier["ap"]["previous"], earlier["ap"]["drift"]) == (0.5, False)
    first = M.drift(stored, as_of=dt.datetime(2001, 1, 2)).first()
    assert first["previous"] is None and not first["drift"]


def test_params_of_every_runner(spark, table):
    fitted = M.ablation(table, ["depth"])[1] + M.per_region(table, ["ASIA"], ["base"])[1]
    pooled, own = (M.run_params(m) for m in fitted)
    assert (pooled["variant"], pooled["class_weight"], pooled["imputation"], pooled["n_features"]) == ("depth", "balanced", "median", "10")
    assert pooled["description"] and (own["region"], own["variant"]) == ("ASIA", "base") and "region" not in pooled
