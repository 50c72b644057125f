"""End-to-end steps on landed feature-collection files (a small hand-made fixture)."""

import datetime as dt
import json
import math
import os
import tempfile

from riskgrid.schema import REFERENCE_REGIONS


def _land(root):
    start, days = dt.datetime(2018, 3, 1), 1500
    for r in REFERENCE_REGIONS:
        per_year = {}
        for i in range(0, days, 2):
            t = start + dt.timedelta(days=i, hours=(i * 7) % 24)
            mag = 2.0 + 4.0 * abs(math.sin(i * 0.37 + len(r.name)))
            lat = r.min_lat + (r.max_lat - r.min_lat) * ((i * 13) % 100) / 100
            lon = r.min_lon + (r.max_lon - r.min_lon) * ((i * 29) % 100) / 100
            kind = "earthquake" if i % 17 else "quarry blast"
            per_year.setdefault(t.year, []).append({
                "id": f"{r.name}{i}", "geometry": {"coordinates": [lon, lat, 5.0 + i % 30]},
                "properties": {"time": int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000),
                               "mag": mag, "magType": "ml", "type": kind, "status": "REVIEWED",
                               "nst": 10, "gap": 50.0, "dmin": 0.1, "rms": 0.2, "place": "x"}})
        os.makedirs(f"{root}/region={r.name}")
        for y, feats in per_year.items():
            with open(f"{root}/region={r.name}/{y}.json", "w") as f:
                json.dump({"type": "FeatureCollection", "features": feats}, f)
    lines = {"type": "FeatureCollection", "features": [
        {"geometry": {"type": "LineString", "coordinates": [[-125, 40], [-115, 33]]}},
        {"geometry": {"type": "MultiLineString", "coordinates": [[[140, 30], [142, 40]], [[20, 35], [28, 38]]]}}]}
    with open(f"{root}/lines.json", "w") as f:
        json.dump(lines, f)


def test_pipeline_steps(spark):
    from pyspark.sql import functions as F

    from riskgrid.plans import pipeline as PL
    root = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    _land(f"{root}/landed")
    raw = PL.ingest(spark, f"{root}/landed", f"{root}/raw")
    assert raw.count() == 3 * 750
    assert set(raw.columns) >= {"id", "region", "time", "magnitude", "nst"}
    segs = PL.load_segments(spark, f"{root}/landed/lines.json")
    assert len(segs) == 3
    clean = PL.clean_and_enrich(spark, f"{root}/raw", f"{root}/clean", segs)
    assert clean.filter(F.col("type") != "earthquake").count() == 0
    assert clean.filter(F.col("status") != "reviewed").count() == 0
    assert clean.filter(F.col("distance_to_fault_km").isNull()).count() == 0
    feats = PL.build_features(spark, f"{root}/clean", f"{root}/features", PL.reference_params(segs))
    assert {r[0] for r in feats.select("split").distinct().collect()} == {"train", "validate", "test"}
    report = PL.check(spark, f"{root}/features")
    assert report.filter("not passed").count() == 0
    assert report.count() == 7
    audit = spark.read.parquet(f"{root}/raw-audit")
    assert audit.count() == 3 * 5 and audit.agg(F.sum("n")).first()[0] == raw.count()
    done = spark.read.parquet(f"{root}/clean-report").first()
    assert (done["rows_before"], done["rows_after"]) == (raw.count(), clean.count())
    board = PL.train(spark, f"{root}/features", f"{root}/runs", ["base", "depth"], f"{root}/models", "run-1").collect()
    PL.train(spark, f"{root}/features", f"{root}/runs", ["base"], f"{root}/models", "run-2")
    PL.train(spark, f"{root}/features", f"{root}/runs", ["base"], None, "run-2")
    log = spark.read.parquet(f"{root}/runs")
    assert {(r["run_id"], r["run"]) for r in log.collect()} == {("run-1", "logreg_base"), ("run-1", "logreg_depth"), ("run-2", "logreg_base")}
    assert log.groupBy("run_id", "run", "split", "region", "metric").count().where("count > 1").count() == 0
    week = PL.forecast(spark, f"{root}/clean", f"{root}/models", f"{root}/forecast").collect()
    assert len(week) == 3 and {r["date"] for r in week} == {clean.agg(F.max(F.to_date("time"))).first()[0]}
    assert [r["run"] for r in board] and all(0 <= r["val_ap"] <= 1 for r in board)
    # The command-line entry point runs the same steps.
    PL.main(["features", "--clean", f"{root}/clean", "--out", f"{root}/features_cli"])
    PL.main(["check", "--features", f"{root}/features_cli"])
    assert spark.read.parquet(f"{root}/features_cli").count() == feats.count()


def test_ingest_keeps_what_was_requested_and_misses_no_region(spark):
    import pytest

    from riskgrid.plans import pipeline as PL
    root = tempfile.mkdtemp(prefix="pipe-", dir="/tmp")
    _land(f"{root}/landed")
    far = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "id": i, "geometry": {"coordinates": [x, 36.0, 1.0]}, "properties": {"time": 0, "mag": mag, "type": "earthquake", "status": "x"}}
        for i, x, mag in (("far", 0.0, 5.0), ("weak", -120.0, 1.9), ("none", -120.0, None), ("edge", -125.0, 2.0))]}
    with open(f"{root}/landed/region=california/more.json", "w") as f:
        json.dump(far, f)
    raw = PL.ingest(spark, f"{root}/landed", f"{root}/raw")
    assert raw.count() == 3 * 750 + 1 and raw.filter("id = 'edge'").count() == 1
    os.makedirs(f"{root}/one")
    os.rename(f"{root}/landed/region=japan", f"{root}/one/region=japan")
    with pytest.raises(FileNotFoundError):
        PL.ingest(spark, f"{root}/one", f"{root}/raw_one")
