"""Cases that the stand-in catalog does not hold: nulls, silent months and years, missing regions, repeated ids, large sums."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskgrid.operators import metrics, planned, profile, spatial
from riskgrid.operators.guards import guard_one_split
from riskgrid.operators.windows import window_features
from riskgrid.schema import Segment


def test_correlation_counts_pairs_only(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 1.0), ("a", 3.0, 5.0), ("a", None, 4.0), ("a", 4.0, float("nan"))]
    r = {x.scope: x for x in profile.correlations(spark.createDataFrame(rows, "region string, x double, y double"), "x", "y").collect()}
    assert r["pooled"].n == r["a"].n == 3
    assert math.isclose(r["a"].t_stat, r["a"].r * math.sqrt(1 / (1 - r["a"].r ** 2)))


def test_empty_months_add_their_expected_count(spark):
    rows = [("a", dt.datetime(2000, m, 1 + i % 20)) for m in (1, 2) for i in range(120)]
    r = profile.seasonality(spark.createDataFrame(rows, "region string, time timestamp")).first()
    assert r.chi2 == pytest.approx(1200) and r.months_seen == 2


def test_a_silent_year_is_a_drop(spark):
    rows = [("a", dt.datetime(y, 5, 1)) for y in (2000, 2000, 2002)] + [("b", dt.datetime(2001, 5, 1))]
    r = {(x.region, x.year): (x.n, x.sharp_drop) for x in profile.catalog_shift(spark.createDataFrame(rows, "region string, time timestamp")).collect()}
    assert r == {("a", 2000): (2, False), ("a", 2001): (0, True), ("a", 2002): (1, False), ("b", 2001): (1, False), ("b", 2002): (0, True)}


def test_wide_gaps_are_counted(spark):
    df = spark.createDataFrame([(1.0, 5.0, 330.0), (-1.0, 6.0, 320.0), (2.0, float("nan"), None)], "depth_km double, magnitude double, gap double")
    r = profile.anomaly_counts(df, 5.5).first()
    assert (r.n_wide_gap, r.negative_depths, r.n_big, r.max_magnitude) == (1, 1, 1, 6.0)


def test_rows_without_a_region_count_overall_only(spark):
    rows = [("r", "test", g, s, y, int(s >= 0.5)) for g, s, y in (("a", .9, 1), ("a", .2, 0), (None, .8, 0), (None, .7, 1))]
    df = spark.createDataFrame(rows, "run string, split string, region string, score double, label int, pred int")
    m = {(x.region, x.metric): x.value for x in metrics.metric_table(df).collect()}
    assert len(m) == 10 and {k[0] for k in m} == {None, "a"}
    assert m[None, "ap"] == pytest.approx((1 + 2 / 3) / 2)


def test_many_segments_with_repeated_and_null_ids(spark):
    segs = [Segment(0, i, -170 + i, -50.0, -169 + i, -45.0 + i % 7) for i in range(60)] + [Segment(1, 0, 0.0, 0.0, 5.0, 5.0)]
    events = spark.createDataFrame([(1, 0.0, 0.0), (1, 100.0, -60.0), (None, 20.0, 10.0), (None, None, 3.0)], "id long, longitude double, latitude double")
    got = {(r.id, r.longitude): r.distance_to_fault_km for r in spatial.add_distance_to_fault(events, segs).collect()}
    assert len(got) == 4 and got[None, None] is None
    for (_, x), y in (((1, 0.0), 0.0), ((1, 100.0), -60.0), ((None, 20.0), 10.0)):
        ends = spatial.np.array([[s.x1, s.y1, s.x2, s.y2] for s in segs])
        assert got[_, x] == pytest.approx(spatial._distances(x, y, ends).min() * 111.0)


def test_window_sums_beyond_bigint(spark):
    big = 9_000_000_000_000_000_000
    days = spark.range(40).select(F.lit("a").alias("region"), F.date_add(F.lit(dt.date(2000, 1, 1)), F.col("id").cast("int")).alias("date"),
                                  F.lit(10).cast("long").alias("n"), *[F.lit(big).cast("long").alias(f"{c}_sum") for c in ("mag", "depth", "dist", "lat", "lon")],
                                  F.lit(1.0).alias("mag_max"), F.lit(0).cast("long").alias("large"))
    last = window_features(days).orderBy(F.desc("date")).first()
    assert last.avg_mag_30d == pytest.approx(big / 10 / 1e6)
    assert planned.long_windows(days, years=(1,), days_per_year=30).orderBy(F.desc("date")).first().avg_mag_1y == pytest.approx(big / 10 / 1e6)


def test_an_empty_table_has_no_splits(spark):
    assert not guard_one_split(spark.createDataFrame([], "region string, date date, split string")).first().passed


def test_a_preset_partition_count_survives(spark):
    from riskgrid.session import get_spark
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        assert get_spark().conf.get("spark.sql.shuffle.partitions") == "17"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_prefix_sums_with_null_keys_and_null_values(spark):
    from riskgrid.operators.ranking import prefix_sums
    rows = [(k, v, 1) for k in ("a", None) for v in [None, *map(float, range(40))]]
    df = spark.createDataFrame(rows, "k string, v double, c bigint")
    for descending in (False, True):
        for ranges in (1, 7):
            got = prefix_sums(df, ["k"], "v", ["c"], descending, ranges).collect()
            assert len(got) == len(rows)
            for r in got:
                place = 0 if r["v"] is None else int(r["v"]) + 1
                assert r["cum_c"] == (41 - place if descending else place + 1)
