"""Streaming tally equals the batch tally; profiling helpers are exact."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001


def test_streaming_tally_equals_batch(spark):
    from riskgrid.operators.grid import daily_tally
    from riskgrid.schema import STANDIN_REGIONS
    from riskgrid.sources.tables import standin_catalog
    from riskgrid.streaming import tally as ST
    cat = standin_catalog(spark, SF001).select("id", "region", "time", "magnitude", "depth_km",
                                               "latitude", "longitude")
    src, log, state = ST.scratch(spark, "src"), ST.scratch(spark, "log"), ST.scratch(spark, "state")
    n_files = ST.land_in_time_order(cat, src)
    assert n_files > 1
    ST.run_to_changelog(spark, src, cat.schema, STANDIN_REGIONS, log, state, watermark="400 days")
    # Several micro-batches ran.
    assert spark.read.parquet(log).select("batch_id").distinct().count() > 1
    cols = ["region", "date", "n", "mag_sum", "mag_max", "large", "depth_sum", "lat_sum", "lon_sum"]
    got = sorted(tuple(r) for r in ST.current_tally(spark, log).select(*cols).collect())
    want = sorted(tuple(r) for r in daily_tally(cat, STANDIN_REGIONS).select(*cols).collect())
    assert got == want
    # A replay with the same checkpoint adds nothing new.
    ST.run_to_changelog(spark, src, cat.schema, STANDIN_REGIONS, log, state, watermark="400 days")
    assert sorted(tuple(r) for r in ST.current_tally(spark, log).select(*cols).collect()) == want


def test_rows_behind_the_watermark_are_counted(spark):
    import datetime as dt

    from riskgrid.schema import STANDIN_REGIONS
    from riskgrid.streaming import tally as ST
    schema = "id long, region string, time timestamp, magnitude double, depth_km double, latitude double, longitude double"

    def land(path, days):
        rows = [(d, "ASIA", dt.datetime(2001, 1, 1) + dt.timedelta(days=d), 1.0, 1.0, 0.0, 0.0) for d in days]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)

    src, log, state = ST.scratch(spark, "src"), ST.scratch(spark, "log"), ST.scratch(spark, "state")
    run = lambda: ST.run_to_changelog(spark, src, schema, STANDIN_REGIONS, log, state)
    land(src, [0, 100])
    assert run() == 0
    land(src, [101, 90])  # within 30 days
    assert run() == 0
    land(src, [5, 6, 102])
    assert run() > 0
    assert {r["date"].day for r in ST.current_tally(spark, log).filter("date < '2001-02-01'").collect()} == {1}


@pytest.fixture(params=["one", "many"])
def ranking_path(request, monkeypatch):
    from riskgrid.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 1_000_000 if request.param == "one" else 3)
    return request.param


def test_exact_median_histogram(spark, ranking_path):
    from riskgrid.operators.profile import exact_median
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 10)] + [("b", v) for v in (5, 5, 7)],
                               "k string, v bigint")
    got = {r["k"]: r["median"] for r in exact_median(df, ["k"], "v").collect()}
    assert got == {"a": 2.5, "b": 5.0}


def test_inter_event_gaps_cross_buckets(spark, ranking_path):
    import datetime as dt
    from riskgrid.operators.profile import inter_event_time
    ts = [dt.datetime(2020, 1, 1, 0, 10), dt.datetime(2020, 1, 1, 0, 40), dt.datetime(2020, 1, 1, 3, 40),
          dt.datetime(2020, 1, 2, 3, 40)]
    df = spark.createDataFrame([("r", t) for t in ts], "region string, time timestamp_ntz")
    r = inter_event_time(df).collect()[0]
    assert r["n_gaps"] == 3
    assert r["mean_gap_h"] == pytest.approx((27.5) / 3)
    assert r["median_gap_h"] == pytest.approx(3.0)


def test_sizing_conf():
    from riskgrid.session import sizing_conf
    c = sizing_conf(100 * 2 ** 40, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) >= 400000
    assert c["spark.sql.adaptive.enabled"] == "true"


def test_inter_event_gaps_with_a_burst_of_identical_times(spark, ranking_path):
    import datetime as dt
    from riskgrid.operators.profile import inter_event_time
    burst = [dt.datetime(2020, 1, 1, 5, 0)] * 5
    ts = burst + [dt.datetime(2020, 1, 1, 7, 0), dt.datetime(2020, 1, 1, 13, 0)]
    df = spark.createDataFrame([("r", t) for t in ts], "region string, time timestamp_ntz")
    r = inter_event_time(df).collect()[0]
    # gaps: 0, 0, 0, 0, 2h, 6h -> median (0 + 0) / 2 = 0, mean 8h / 6
    assert r["n_gaps"] == 6 and r["median_gap_h"] == 0.0
    assert r["mean_gap_h"] == pytest.approx(8 / 6)


def test_landed_files_follow_rows_not_shuffle_partitions(spark):
    import datetime as dt
    import os

    from riskgrid.streaming import tally as ST
    rows = [(i, dt.datetime(1999 + i % 2, 3, 1) + dt.timedelta(days=i)) for i in range(60)] + [(None, dt.datetime(2000, 1, 1)), (7, None)]
    events = spark.createDataFrame(rows, "id long, time timestamp_ntz")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 50)
    try:
        src = ST.scratch(spark, "src")
        assert ST.land_in_time_order(events, src) == 2
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    landed = spark.read.parquet(src)
    assert landed.schema == events.schema
    assert sorted(landed.collect(), key=str) == sorted([r for r in events.collect() if r["time"] is not None], key=str)
    assert len([f for f in os.listdir(src.removeprefix("file:")) if f.endswith(".parquet")]) <= 4
