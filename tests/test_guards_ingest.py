"""Guards fail loudly; ingest, sinks and the source guard behave."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001


def test_guards_pass_on_pipeline_and_fail_on_overlap(spark):
    from riskgrid.operators.guards import assert_guards, guard_report
    from riskgrid.plans.feature_table import feature_table
    from riskgrid.schema import PipelineParams
    t = feature_table(spark, SF001, PipelineParams(), written=True)
    assert_guards(guard_report(t))
    # Relabel the first validation days as train: the embargo guard must fail.
    bad = t.withColumn("split", F.when((F.col("split") == "validate") & (F.col("date") < "1999-01-05"),
                                       "train").otherwise(F.col("split")))
    with pytest.raises(AssertionError, match="embargo"):
        assert_guards(guard_report(bad))


def test_feature_collection_files(spark):
    from riskgrid.sources.ingest import read_feature_collections
    root = tempfile.mkdtemp(prefix="fc-", dir="/tmp")
    os.makedirs(f"{root}/region=japan")
    doc = {"type": "FeatureCollection", "features": [
        {"id": "x1", "properties": {"time": 1262304000500, "mag": 5.6, "magType": "mw", "place": "p",
                                    "type": "earthquake", "status": "REVIEWED", "nst": None},
         "geometry": {"coordinates": [140.5, 35.25, 12.0]}},
        {"id": "x2", "properties": {"time": 0, "mag": None, "type": "quarry blast", "status": "automatic"},
         "geometry": {"coordinates": [141.0, 36.0, -1.5]}}]}
    with open(f"{root}/region=japan/2010.json", "w") as f:
        json.dump(doc, f, indent=2)
    rows = {r["id"]: r for r in read_feature_collections(spark, root).collect()}
    assert rows["x1"]["region"] == "japan" and rows["x1"]["longitude"] == 140.5
    assert rows["x1"]["latitude"] == 35.25 and rows["x1"]["depth_km"] == 12.0
    assert rows["x1"]["time"] == dt.datetime(2010, 1, 1, 0, 0, 0, 500000)
    assert rows["x2"]["magnitude"] is None and rows["x2"]["depth_km"] == -1.5


def test_write_by_region_round_trip_and_source_guard(spark):
    from riskgrid.sources.ingest import check_sources, read_catalog, write_by_region
    from riskgrid.sources.tables import standin_catalog
    cat = standin_catalog(spark, SF001).select("id", "region", "time", "magnitude")
    path = tempfile.mkdtemp(prefix="cat-", dir="/tmp") + "/catalog"
    write_by_region(cat, path)
    write_by_region(cat, path)  # overwrite: a re-run never duplicates
    back = read_catalog(spark, path, cat.drop("region").schema)
    assert back.count() == cat.count()
    check_sources(back, ["ASIA", "EUROPE"])
    with pytest.raises(FileNotFoundError):
        check_sources(back, ["ATLANTIS"])
