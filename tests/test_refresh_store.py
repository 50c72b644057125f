"""Stored models, optimality certificates and the incremental refresh against full rebuilds."""

import dataclasses
import datetime as dt
import random
import types

import pytest
from pyspark.sql import functions as F

from riskgrid.operators.grid import daily_grid, daily_tally, gap_filled_tally
from riskgrid.operators.windows import as_feature_table, window_features
from riskgrid.plans import models as M
from riskgrid.plans.feature_table import feature_table, grid_features
from riskgrid.plans.model_store import forecast, load_model, manifests, save_model, versions
from riskgrid.plans.refresh import KEYS, RefreshStore
from riskgrid.schema import PipelineParams, Region
from riskgrid.session import file_stamp

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def table(spark):
    return feature_table(spark, SF001, written=True)


@pytest.fixture(scope="module")
def fitted(table):
    return M.ablation(table, ["depth"])[1][0]


def test_stored_model_scores_as_the_fitted_one(spark, table, fitted, tmp_path):
    train = table.filter("split = 'train'")
    assert save_model(fitted, train, str(tmp_path), dt.datetime(2001, 1, 1)) == 1
    assert save_model(fitted, train, str(tmp_path), dt.datetime(2001, 2, 1)) == 2
    loaded = load_model(spark, str(tmp_path), fitted.run)
    assert (loaded.names, loaded.stats, loaded.categories) == (fitted.names, {c: tuple(map(float, v)) for c, v in fitted.stats.items()}, fitted.categories)
    assert sorted(loaded.score(table).collect()) == sorted(fitted.score(table).collect())
    rows = forecast(loaded, grid_features(spark, SF001)).collect()
    assert len(rows) == len({r["region"] for r in rows}) == 5 and all(0 <= r["score"] <= 1 for r in rows)
    m = {r["version"]: r for r in manifests(spark, str(tmp_path), fitted.run).collect()}
    assert m[1]["train_rows"] == train.count() and m[2]["features"] == fitted.names and m[1]["train_last"] <= dt.date(1998, 12, 24)


def test_versions_are_chosen_by_time_and_unfinished_ones_do_not_count(spark, table, fitted, tmp_path):
    root = str(tmp_path)
    save_model(fitted, table, root, dt.datetime(2001, 1, 1))
    other = dataclasses.replace(fitted, stats={c: (m, mu + 1, sd) for c, (m, mu, sd) in fitted.stats.items()})
    save_model(other, table, root, dt.datetime(2001, 2, 1))
    assert load_model(spark, root, fitted.run, as_of=dt.datetime(2001, 1, 15)).stats == load_model(spark, root, fitted.run, version=1).stats
    assert load_model(spark, root, fitted.run).stats["trend_7d"][1] == fitted.stats["trend_7d"][1] + 1
    cut_off = tmp_path / fitted.run / "version=3" / "design"
    cut_off.mkdir(parents=True)
    (cut_off / "junk").write_text("x")
    assert versions(spark, root, fitted.run) == [1, 2]
    assert save_model(fitted, table, root, dt.datetime(2001, 3, 1)) == 3
    with pytest.raises(LookupError):
        load_model(spark, root, fitted.run, as_of=dt.datetime(2000, 1, 1))
    with pytest.raises(LookupError):
        load_model(spark, root, "unknown")


def test_stored_forest_scores_as_the_fitted_one(spark, table, tmp_path):
    train = table.filter("split = 'train'")
    forest = M.fit_forest(train, ["quakes_7d", "avg_mag_7d"], ["region"], "small_forest", trees=5, max_depth=4)
    save_model(forest, train, str(tmp_path), dt.datetime(2001, 1, 1))
    assert sorted(load_model(spark, str(tmp_path), "small_forest").score(table).collect()) == sorted(forest.score(table).collect())


@pytest.mark.parametrize("which", ["coefficient", "intercept"])
def test_certificate_falls_when_a_coefficient_is_changed(table, fitted, which):
    beta, bias = fitted.model.coefficients.toArray().copy(), float(fitted.model.intercept)
    if which == "coefficient":
        beta[3] += 0.01
    else:
        bias += 0.01
    wrong = dataclasses.replace(fitted, run="wrong", model=types.SimpleNamespace(coefficients=types.SimpleNamespace(toArray=lambda: beta), intercept=bias))
    ok = {r["run"]: r["residual_ok"] for r in M.certificates([(table, [fitted, wrong])]).collect()}
    assert ok == {fitted.run: True, "wrong": False}


# ---------------------------------------------------------------------------
# Refresh
# ---------------------------------------------------------------------------

PARAMS = PipelineParams(regions=[Region("a", 5.0), Region("b", 6.0)], segments=[])
SCHEMA = "id long, region string, date date, magnitude double, depth_km double, latitude double, longitude double, distance_to_fault_km double"
START = dt.date(2000, 1, 1)


def event(rnd, i, low, high, region=None):
    return (i, region or rnd.choice(["a", "a", "a", "b", "elsewhere"]), START + dt.timedelta(days=rnd.randint(low, high)), rnd.choice([3.0, 5.5, 6.5, None, float("nan")]),
            rnd.choice([10.0, None]), rnd.uniform(-5, 5), rnd.uniform(-5, 5), rnd.choice([1.5, 7.25]))


def rebuilt(spark, batches):
    """All events that count, built at once: of each id, the row of the highest batch."""
    newest = {}
    for number, rows in sorted(batches.items()):
        for r in rows:
            newest[r[0]] = r
    events = spark.createDataFrame([r for r in newest.values() if r[1] is not None and r[2] is not None], SCHEMA)
    tally = daily_tally(events, PARAMS.regions).cache()
    return as_feature_table(window_features(gap_filled_tally(daily_grid(spark, tally, PARAMS.regions), tally)))


def same(store, spark, batches):
    want = rebuilt(spark, batches)
    got = store.features().select(want.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_refresh_equals_a_full_rebuild_after_every_batch(spark, tmp_path):
    rnd = random.Random(3)
    store, batches = RefreshStore(spark, str(tmp_path / "store"), PARAMS, late_days=20), {}

    def apply(number, rows):
        batches[number] = rows
        report = store.apply(spark.createDataFrame(rows, SCHEMA), number).first()
        same(store, spark, batches)
        return report

    first = apply(1, [event(rnd, i, 40, 200) for i in range(60)] + [(900, None, START, 6.0, 1.0, 0.0, 0.0, 1.0), (901, "a", None, 6.0, 1.0, 0.0, 0.0, 1.0)])
    assert first["rebuilt"] and first["unkeyed"] == 2 and first["late"] == 0
    # Late rows, and days far behind the newest one: a long silence before its next event.
    late = apply(2, [event(rnd, i, 60, 120) for i in range(60, 64)] + [event(rnd, 64, 290, 290, "a")])
    assert not late["rebuilt"] and late["late"] == 4 and late["rows"] == 5
    # A silence is broken in its middle; the calendar does not move.
    quiet = apply(3, [event(rnd, 70, 250, 250, "a")])
    assert not quiet["rebuilt"] and quiet["feature_rows"] < store.features().count()
    # Revised events: another day, another region, and one out of the regions.
    apply(4, [(*event(rnd, 5, 100, 100, "b"),), (*event(rnd, 6, 41, 41, "elsewhere"),), event(rnd, 64, 280, 280, "b"), (7, "a", START + dt.timedelta(days=45), 6.5, 1.0, 0.0, 0.0, 1.0)])
    # A batch lands again, as it was and with other rows.
    again = apply(3, batches[3])
    assert not again["rebuilt"]
    apply(3, [event(rnd, 71, 255, 255, "b")])
    apply(2, [])
    # Rows before the first day: the start of the calendar moves.
    assert apply(5, [event(rnd, 80, 0, 10, "b")])["rebuilt"]


def test_a_batch_writes_only_the_months_it_reaches(spark, tmp_path):
    rnd = random.Random(4)
    root = str(tmp_path / "store")
    store = RefreshStore(spark, root, PARAMS)
    store.apply(spark.createDataFrame([event(rnd, i, 0, 400, "a") for i in range(300)], SCHEMA), 1)
    before = dict(zip(("tally", "features"), file_stamp(spark, [f"{root}/tally", f"{root}/features"])))
    store.apply(spark.createDataFrame([event(rnd, 999, 200, 200, "a")], SCHEMA), 2)
    after = dict(zip(("tally", "features"), file_stamp(spark, [f"{root}/tally", f"{root}/features"])))
    months = lambda files: {f[0].split("month=")[1][:8] for f in files if "month=" in f[0]}
    assert months(set(after["tally"]) - set(before["tally"])) == {"m2000-07"}
    assert months(set(after["features"]) - set(before["features"])) == {"m2000-07", "m2000-08"}


def test_a_batch_cut_off_before_its_tally_is_mended_by_applying_it_again(spark, tmp_path, monkeypatch):
    rnd = random.Random(5)
    batches = {1: [event(rnd, i, 0, 100) for i in range(50)], 2: [event(rnd, i, 50, 100) for i in range(20)]}
    store = RefreshStore(spark, str(tmp_path / "store"), PARAMS)
    store.apply(spark.createDataFrame(batches[1], SCHEMA), 1)
    with monkeypatch.context() as m:
        m.setattr(RefreshStore, "_upsert", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.apply(spark.createDataFrame(batches[2] + [event(rnd, 60, 70, 70, "a")], SCHEMA), 2)
    store.apply(spark.createDataFrame(batches[2], SCHEMA), 2)  # with one event less than what was landed
    same(store, spark, batches)
    assert store.tally().groupBy(*KEYS).count().where("count > 1").count() == 0
    assert store._read("tally").agg(F.min("n")).first()[0] >= 0


def test_a_batch_is_written_once_and_only_rows_with_a_key_count(spark, tmp_path, monkeypatch):
    from riskgrid.plans import refresh
    written = []
    monkeypatch.setattr(refresh, "materialize", lambda df, name, keep=refresh.materialize: written.append(name) or keep(df, name))
    rnd = random.Random(6)
    rows = [event(rnd, i, 0, 60) for i in range(30)]
    store = RefreshStore(spark, str(tmp_path / "store"), PARAMS)
    report = store.apply(spark.createDataFrame(rows + [(900, None, START, 6.0, 1.0, 0.0, 0.0, 1.0), (901, "a", None, 6.0, 1.0, 0.0, 0.0, 1.0)], SCHEMA), 1).first()
    assert "refresh-batch" not in written and not (tmp_path / "store/landing/batch=1").exists()
    assert (report["rows"], report["unkeyed"]) == (32, 2) and sorted(r["id"] for r in store._events().collect()) == list(range(30))
    same(store, spark, {1: rows})
