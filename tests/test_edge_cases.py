"""Hand-made edge cases (FIXTURES part C) on tiny catalogs."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from riskgrid.operators.grid import daily_grid, daily_tally, gap_filled_tally
from riskgrid.operators.split import assign_split, drop_unobservable, split_summary
from riskgrid.operators.windows import as_feature_table, window_features
from riskgrid.schema import REFERENCE_REGIONS, REFERENCE_SPLIT, Region
from riskgrid.session import materialize

D0 = dt.date(2020, 1, 1)
CAT_SCHEMA = ("region string, date date, magnitude double, depth_km double, latitude double, "
              "longitude double, distance_to_fault_km double")
REGS = [Region("a", 5.0), Region("b", 5.0)]


def day(i):
    return D0 + dt.timedelta(days=i)


def catalog(spark, rows):
    full = [(r[0], r[1], r[2], r[3] if len(r) > 3 else 1.0, 10.0, 20.0, 3.0) for r in rows]
    return spark.createDataFrame(full, CAT_SCHEMA)


def features(spark, rows, regions=REGS, horizon=7):
    tally = materialize(daily_tally(catalog(spark, rows), regions), "t")
    grid = daily_grid(spark, tally, regions)
    out = as_feature_table(window_features(gap_filled_tally(grid, tally), horizon))
    return {(r["region"], r["date"]): r for r in out.collect()}


def test_c1_calendar_and_split_sizes(spark):
    # Events only in a region outside the list: they stretch the calendar and nothing else.
    rows = [("elsewhere", dt.date(2000, 1, 1), 3.0), ("elsewhere", dt.date(2026, 7, 6), 3.0)]
    tally = materialize(daily_tally(catalog(spark, rows), REFERENCE_REGIONS), "t")
    grid = daily_grid(spark, tally, REFERENCE_REGIONS)
    assert grid.count() == 3 * 9684
    feats = window_features(gap_filled_tally(grid, tally))
    assert feats.filter(F.col("label_7d").isNull()).count() == 21
    kept = drop_unobservable(feats)
    summary = {r["split"]: r for r in split_summary(kept, REFERENCE_SPLIT).collect()}
    assert summary["train"]["rows"] == 20799
    assert summary["validate"]["rows"] == 3267
    assert summary["test"]["rows"] == 4923
    assert summary["train"]["dropped"] == 42


def test_c2_embargo_edges(spark):
    dates = [dt.date(2018, 12, 24), dt.date(2018, 12, 25), dt.date(2019, 1, 1),
             dt.date(2021, 12, 24), dt.date(2021, 12, 25), dt.date(2022, 1, 1), None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(dates)], "i int, date date")
    got = {r["i"]: r["split"] for r in assign_split(df, REFERENCE_SPLIT).collect()}
    assert got == {0: "train", 2: "validate", 3: "validate", 5: "test"}


def test_c2_event_grain_timestamps(spark):
    df = spark.createDataFrame([(1, dt.datetime(2018, 12, 24, 23, 59, 59, 999999)),
                                (2, dt.datetime(2018, 12, 25, 0, 0, 0))], "i int, time timestamp_ntz")
    got = {r["i"]: r["split"] for r in assign_split(df, REFERENCE_SPLIT, "time").collect()}
    assert got == {1: "train"}


def test_c3_quiet_stretch(spark):
    rows = [("a", day(0), 4.0), ("a", day(41), 4.0), ("b", day(0), 4.0)]
    f = features(spark, rows)
    assert f[("a", day(6))]["quakes_7d"] == 1 and f[("a", day(7))]["quakes_7d"] == 0
    assert f[("a", day(29))]["quakes_30d"] == 1 and f[("a", day(30))]["quakes_30d"] == 0
    assert f[("a", day(29))]["avg_mag_30d"] == 4.0
    assert f[("a", day(30))]["avg_mag_30d"] is None and f[("a", day(30))]["max_mag_30d"] is None
    assert f[("a", day(7))]["avg_mag_7d"] is None
    assert [f[("a", day(i))]["days_since_last"] for i in (0, 1, 35, 40)] == [0, 1, 35, 40]
    assert f[("a", day(41))]["days_since_last"] == 0


def test_c4_before_first_event(spark):
    rows = [("a", day(0), 3.0), ("b", day(5), 3.0), ("b", day(20), 3.0)]
    f = features(spark, rows)
    assert f[("b", day(4))]["days_since_last"] is None
    assert f[("b", day(4))]["quakes_7d"] == 0
    assert all(f[("b", day(i))]["trend_7d"] is None for i in range(7))
    assert f[("b", day(7))]["trend_7d"] == 1.0  # n7(day 7) = 1, n7(day 0) = 0


def test_c5_label_window(spark):
    rows = [("a", day(0), 1.0), ("a", day(10), 6.0), ("a", day(30), 1.0), ("b", day(0), 1.0)]
    f = features(spark, rows)
    labels = {i: f[("a", day(i))]["label_7d"] for i in range(31)}
    assert [labels[i] for i in range(3, 10)] == [1] * 7
    assert labels[2] == 0 and labels[10] == 0
    assert all(labels[i] is None for i in range(24, 31))
    assert labels[23] == 0


def test_c6_missing_depth_divides_by_event_count(spark):
    rows = [("a", day(0), 3.0, 10.0), ("a", day(0), 3.0, None), ("b", day(0), 3.0, None)]
    f = features(spark, rows)
    assert f[("a", day(0))]["avg_depth_30d"] == pytest.approx(5.0)
    # An all-missing day sums to 0, not null, while it has events.
    assert f[("b", day(0))]["avg_depth_30d"] == 0.0


def test_c7_nan_magnitude_not_large(spark):
    rows = [("a", day(0), float("nan")), ("a", day(1), 6.0), ("a", day(9), 1.0), ("b", day(0), 1.0)]
    tally = daily_tally(catalog(spark, rows), REGS).collect()
    t = {(r["region"], r["date"]): r for r in tally}
    assert t[("a", day(0))]["large"] == 0 and t[("a", day(0))]["mag_max"] is None
    assert t[("a", day(1))]["large"] == 1


def test_c8_extra_region_only_stretches_calendar(spark):
    rows = [("a", day(0), 3.0), ("zz", day(20), 9.0)]
    f = features(spark, rows, [Region("a", 5.0)])
    assert max(k[1] for k in f) == day(20)
    assert {k[0] for k in f} == {"a"}
    assert f[("a", day(20))]["quakes_7d"] == 0


def test_c9_median_interpolates(spark):
    from riskgrid.operators.prep import fit_numeric
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert fit_numeric(df, ["x"])["x"][0] == 2.5


def test_c10_standardize_population_std(spark):
    from riskgrid.operators.prep import fit_numeric, standardize
    for vals, want in (([1.0, 3.0], [-1.0, 1.0]), ([5.0, 5.0], [0.0, 0.0])):
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        fitted = fit_numeric(df, ["x"])
        got = sorted(r[0] for r in df.select(standardize("x", fitted)).collect())
        assert got == pytest.approx(want)


def _scored(spark, scores, labels, region="r"):
    rows = [("run", "validate", region, s, y, int(s >= 0.5)) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "run string, split string, region string, score double, label int, pred int")


@pytest.fixture(params=["one", "many"])
def ranking_path(request, monkeypatch):
    """Run a test with one range per group and with many."""
    from riskgrid.operators import ranking
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 1_000_000 if request.param == "one" else 3)
    return request.param


def test_c11_average_precision_with_tie(spark, ranking_path):
    from riskgrid.operators.metrics import average_precision
    s = _scored(spark, [.9, .8, .7, .7, .3, .1], [1, 0, 1, 0, 1, 0])
    assert average_precision(s, ["run"]).collect()[0]["ap"] == pytest.approx(0.7)
    assert average_precision(s).collect()[0]["ap"] == pytest.approx(0.7)
    # Same answer when every distinct score sits in its own range.
    assert average_precision(s, ["run"], buckets=2).collect()[0]["ap"] == pytest.approx(0.7)


def test_ap_matches_brute_force_many_buckets(spark, ranking_path):
    import random
    from riskgrid.operators.metrics import average_precision
    rnd = random.Random(7)
    scores = [round(rnd.random(), 2) for _ in range(2000)]
    labels = [int(rnd.random() < s) for s in scores]
    pairs = sorted(zip(scores, labels), key=lambda p: -p[0])
    P = sum(labels)
    ap, tp, seen, i = 0.0, 0, 0, 0
    while i < len(pairs):
        j = i
        while j < len(pairs) and pairs[j][0] == pairs[i][0]:
            j += 1
        pos = sum(y for _, y in pairs[i:j])
        tp += pos
        seen += j - i
        ap += pos / P * tp / seen
        i = j
    got = average_precision(_scored(spark, scores, labels), ["run"], buckets=16).collect()[0]["ap"]
    assert got == pytest.approx(ap, rel=1e-12)


def test_c12_threshold_tie_is_positive(spark):
    from riskgrid.operators.metrics import decision
    assert spark.range(1).select(decision(F.lit(0.5))).collect()[0][0] == 1


def test_c13_single_class_region_absent(spark, ranking_path):
    from riskgrid.operators.metrics import metric_table
    s = _scored(spark, [.9, .2, .6], [1, 0, 1], "mixed").unionByName(_scored(spark, [.4, .3], [0, 0], "flat"))
    rows = metric_table(s).collect()
    regions = {r["region"] for r in rows}
    assert "flat" not in regions and "mixed" in regions and None in regions


def test_c14_interaction_of_null_is_null_everywhere(spark):
    from riskgrid.operators.prep import interactions
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "region string, f double")
    out, names = interactions(df, "f", ["a", "b"])
    rows = {r["region"]: r for r in out.collect()}
    assert all(rows["a"][n] is None for n in names)
    assert rows["b"]["f__a"] == 0.0 and rows["b"]["f__b"] == 2.0


def test_c15_year_boundary_half_open(spark):
    from riskgrid.operators.clean import catalog_filter
    df = spark.createDataFrame([(1, dt.datetime(2010, 12, 31, 23, 59, 59, 500000), 3.0),
                                (2, dt.datetime(2011, 1, 1, 0, 0, 0), 3.0)],
                               "id int, time timestamp_ntz, magnitude double")
    got = [r["id"] for r in catalog_filter(df, year=2010).collect()]
    assert got == [1]


C16_SEGMENTS = None


def _c16_segments():
    from riskgrid.schema import Segment
    return [Segment(0, 0, 0, 0, 10, 0), Segment(1, 0, 0, 5, 0, 20), Segment(2, 0, 3, 3, 3, 3)]


def test_c16_nearest_segment(spark):
    from riskgrid.operators.spatial import add_distance_to_fault
    pts = spark.createDataFrame([(1, 5.0, 2.0), (2, -3.0, -4.0), (3, 1.0, 10.0), (4, 3.0, 4.0)],
                                "id int, longitude double, latitude double")
    got = {r["id"]: r["distance_to_fault_km"] for r in add_distance_to_fault(pts, _c16_segments()).collect()}
    assert got == {1: pytest.approx(222.0), 2: pytest.approx(555.0), 3: pytest.approx(111.0), 4: pytest.approx(111.0)}


def test_nearest_segment_cell_index_equals_brute_force(spark):
    """The cell index gives exactly the brute-force minimum, off the globe too."""
    import random
    from riskgrid.operators import spatial
    from riskgrid.schema import Segment
    rnd = random.Random(3)
    segs = []
    for i in range(60):
        x, y = rnd.uniform(-170, 170), rnd.uniform(-80, 80)
        segs.append(Segment(i, 0, x, y, x + rnd.uniform(-8, 8), y + rnd.uniform(-8, 8)))
    segs.append(Segment(99, 0, 10.0, 10.0, 10.0, 10.0))
    pts = [(i, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(400)]
    pts += [(400, 180.0, 90.0), (401, -180.0, -90.0), (402, 0.0, 0.0), (403, 300.0, 10.0), (404, 20.0, -100.0)]
    df = spark.createDataFrame(pts, "id int, longitude double, latitude double")
    fast = {r["id"]: r["distance_to_fault_km"]
            for r in spatial.add_distance_to_fault(df, segs).collect()}

    def seg_d(px, py, s):
        dx, dy = s.x2 - s.x1, s.y2 - s.y1
        l2 = dx * dx + dy * dy
        t = 0.0 if l2 == 0 else min(1.0, max(0.0, ((px - s.x1) * dx + (py - s.y1) * dy) / l2))
        return math.hypot(px - (s.x1 + t * dx), py - (s.y1 + t * dy))
    for i, px, py in pts:
        assert fast[i] == pytest.approx(min(seg_d(px, py, s) for s in segs) * 111.0, rel=1e-12)


def test_geodesic_segment_distance(spark):
    from riskgrid.operators.planned import geodesic_distance_to_fault
    from riskgrid.schema import Segment
    seg = [Segment(0, 0, 10.0, -10.0, 10.0, 10.0)]   # a meridian piece at lon 10
    pts = spark.createDataFrame([(1, 0.0, 0.0), (2, 20.0, 10.0), (3, 0.0, 10.0)],
                                "id int, latitude double, longitude double")
    got = {r["id"]: r["geodesic_km"] for r in geodesic_distance_to_fault(pts, seg).collect()}
    deg = 6371.0 * math.pi / 180.0
    assert got[1] == pytest.approx(10 * deg, rel=1e-9)      # cross-track
    assert got[2] == pytest.approx(10 * deg, rel=1e-9)      # beyond the north end: distance to (10, 10)
    assert got[3] == pytest.approx(0.0, abs=1e-6)           # on the segment


def test_box_join_equals_brute_force(spark):
    import random
    from riskgrid.operators import spatial
    from riskgrid.schema import Region
    rnd = random.Random(5)
    boxes = []
    for i in range(12):
        la, lo = rnd.uniform(-60, 50), rnd.uniform(-170, 150)
        boxes.append(Region(f"b{i}", 1.0, la, la + rnd.uniform(0.5, 15), lo, lo + rnd.uniform(0.5, 20)))
    boxes.append(Region("edge", 1.0, 10.0, 20.0, 30.0, 40.0))
    pts = [(i, rnd.uniform(-70, 70), rnd.uniform(-180, 180)) for i in range(3000)]
    pts += [(9001, 10.0, 30.0), (9002, 20.0, 40.0), (9003, 15.0, 40.0)]     # on box edges
    pts.append((9004, 95.0, 35.0))                                          # off the globe, in a box
    boxes.append(Region("beyond", 1.0, 80.0, 100.0, 30.0, 40.0))
    df = spark.createDataFrame([*pts, (9005, None, 35.0)], "id int, latitude double, longitude double")
    got = sorted((r["id"], r["box_region"]) for r in spatial.box_join(df, boxes).collect())
    assert got == sorted((i, b.name) for i, la, lo in pts for b in boxes
                         if b.min_lat <= la <= b.max_lat and b.min_lon <= lo <= b.max_lon)
    assert len(got) > 50 and {(9001, "edge"), (9002, "edge"), (9003, "edge"), (9004, "beyond")} <= set(got)
    with pytest.raises(ValueError, match="without a box: .'open'"):
        spatial.box_join(df, [*boxes, Region("open", 1.0)])


def test_dense_map_equals_brute_force(spark):
    import random
    from riskgrid.operators.spatial import add_distance_to_fault
    from riskgrid.schema import Segment
    rnd = random.Random(9)
    segs = [Segment(i, 0, *(rnd.uniform(-170, 170), rnd.uniform(-80, 80)) * 1, 0.0, 0.0)
            for i in range(5000)]
    segs = [Segment(s.line_id, 0, s.x1, s.y1, s.x1 + rnd.uniform(-5, 5), s.y1 + rnd.uniform(-5, 5)) for s in segs]
    pts = [(i, rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for i in range(300)]
    df = spark.createDataFrame(pts, "id int, longitude double, latitude double")
    got = {r["id"]: r["distance_to_fault_km"] for r in add_distance_to_fault(df, segs).collect()}

    def seg_d(px, py, s):
        dx, dy = s.x2 - s.x1, s.y2 - s.y1
        l2 = dx * dx + dy * dy
        t = 0.0 if l2 == 0 else min(1.0, max(0.0, ((px - s.x1) * dx + (py - s.y1) * dy) / l2))
        return math.hypot(px - (s.x1 + t * dx), py - (s.y1 + t * dy))
    for i, px, py in pts:
        assert got[i] == pytest.approx(min(seg_d(px, py, s) for s in segs) * 111.0, rel=1e-12)


def test_train_medians_histogram_path_equals_aggregate(spark, monkeypatch):
    import random
    from riskgrid.operators import prep, ranking
    rnd = random.Random(4)
    rows = [(rnd.choice([None, round(rnd.uniform(0, 5), 1)]), float(rnd.randint(0, 30))) for _ in range(501)]
    df = spark.createDataFrame(rows, "a double, b double")
    from pyspark.sql import functions as F
    small = df.agg(F.median("a").alias("a"), F.median("b").alias("b")).first().asDict()
    assert prep.train_medians(df, ["a", "b"]) == pytest.approx(small)
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 3)
    big = prep.train_medians(df, ["a", "b"])
    assert big == pytest.approx(small)
    assert prep.fit_numeric(df, ["a", "b"])["a"][0] == pytest.approx(small["a"])
