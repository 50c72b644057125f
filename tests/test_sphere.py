"""Nearest segment on the sphere against all pairs of places and segments."""

import numpy as np
import pytest

from riskgrid.operators import sphere

PLACES = "id long, latitude double, longitude double"
SEGMENTS = "x1 double, y1 double, x2 double, y2 double"


def vectors(lat, lon):
    la, lo = np.radians(lat), np.radians(lon)
    return np.stack([np.cos(la) * np.cos(lo), np.cos(la) * np.sin(lo), np.sin(la)], -1)


def all_pairs(places, segments):
    """Least angle to 20,001 points of each arc: an upper bound that is at most some metres too large."""
    out = []
    t = np.linspace(0, 1, 20001)[:, None]
    arcs = []
    for x1, y1, x2, y2 in segments:
        a, b = vectors(y1, x1), vectors(y2, x2)
        w = np.arccos(np.clip(a @ b, -1, 1))
        arcs.append(a[None] if w < 1e-12 else (np.sin((1 - t) * w) * a + np.sin(t * w) * b) / np.sin(w))
    for lat, lon in places:
        p = vectors(lat, lon)
        out.append(min(2 * np.arcsin(np.linalg.norm(arc - p, axis=1).min() / 2) for arc in arcs) * sphere.EARTH_KM)
    return np.array(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_nearest_segment_equals_all_pairs(spark, seed):
    rnd = np.random.default_rng(seed)
    places = [(float(a), float(b)) for a, b in zip(rnd.uniform(-90, 90, 60), rnd.uniform(-180, 180, 60))]
    places += [(90.0, 0.0), (-90.0, 77.0), (89.9, -120.0), (0.0, 180.0), (0.0, -180.0), (12.0, 179.99), (-45.0, 190.0), (30.0, 30.0), (30.0, 30.0)]
    start = np.stack([rnd.uniform(-180, 180, 25), rnd.uniform(-88, 88, 25)], 1)
    segments = [(float(x), float(y), float(x + dx), float(np.clip(y + dy, -90, 90))) for (x, y), (dx, dy) in zip(start, rnd.uniform(-9, 9, (25, 2)))]
    segments += [(178.0, 10.0, -178.0, 14.0), (0.0, 88.0, 180.0, 87.0), (-30.0, -89.0, 100.0, -89.0), (5.0, 5.0, 5.0, 5.0), (-150.0, 0.0, -20.0, 40.0), (10.0, -20.0, 10.0, 70.0)]
    got = sphere.nearest_segment_km(spark.createDataFrame([(i, *p) for i, p in enumerate(places)], PLACES).repartition(3), spark.createDataFrame(segments, SEGMENTS))
    rows = {r["id"]: r["geodesic_km"] for r in got.collect()}
    want = all_pairs(places, segments)
    assert len(rows) == len(places)
    assert np.abs(np.array([rows[i] for i in range(len(places))]) - want).max() < 0.05


def test_thousands_of_segments_in_one_place(spark):
    rnd = np.random.default_rng(3)
    ends = rnd.uniform(0, 1, (3000, 2))
    segments = [(10 + float(x), 50 + float(y), 10 + float(x) + 0.001, 50 + float(y)) for x, y in ends]
    places = [(50.0 + float(a), 10.0 + float(b)) for a, b in rnd.uniform(0, 1, (200, 2))] + [(-40.0, -100.0)]
    got = sphere.nearest_segment_km(spark.createDataFrame([(i, *p) for i, p in enumerate(places)], PLACES), spark.createDataFrame(segments, SEGMENTS))
    rows = {r["id"]: r["geodesic_km"] for r in got.collect()}
    for i, (lat, lon) in enumerate(places):
        a, b, p = vectors(*np.array([(s[1], s[0]) for s in segments]).T), vectors(*np.array([(s[3], s[2]) for s in segments]).T), vectors(lat, lon)
        least = min(2 * np.arcsin(np.linalg.norm(e - p, axis=1).min() / 2) for e in (a, b)) * sphere.EARTH_KM
        assert least - 0.05 < rows[i] <= least + 1e-6  # segments of 70 m at most


def test_places_off_the_globe_nulls_and_empty_maps(spark):
    bad = [(1, None, 5.0), (2, 5.0, None), (3, float("nan"), 5.0), (4, 5.0, float("inf")), (5, 91.0, 5.0), (6, 0.0, 0.0), (None, 0.0, 0.0), (6, 0.0, 0.0)]
    places = spark.createDataFrame(bad, PLACES)
    rows = sphere.nearest_segment_km(places, spark.createDataFrame([(0.0, 1.0, 0.0, 1.0), (None, 0.0, 0.0, 0.0), (float("nan"), 0.0, 0.0, 0.0)], SEGMENTS)).collect()
    assert len(rows) == len(bad)
    degree = np.pi / 180 * sphere.EARTH_KM
    assert [r["geodesic_km"] for r in rows if r["id"] in (1, 2, 3, 4, 5)] == [None] * 5
    assert all(abs(r["geodesic_km"] - degree) < 1e-9 for r in rows if r["id"] in (6, None))
    assert [r["geodesic_km"] for r in sphere.nearest_segment_km(places, spark.createDataFrame([], SEGMENTS)).collect()] == [None] * len(bad)
    assert sphere.nearest_segment_km(places.limit(0), spark.createDataFrame([(0.0, 1.0, 0.0, 1.0)], SEGMENTS)).collect() == []


def test_cells_and_their_parents(spark):
    from pyspark.sql import functions as F
    places = spark.createDataFrame([(float(a), float(b)) for a in np.linspace(-90, 90, 41) for b in np.linspace(-180, 180, 41)], "lat double, lon double")
    for coarse, fine in zip(sphere.SIDES, sphere.SIDES[1:]):
        at = lambda side: sphere.cell(F.col("lat"), F.col("lon"), side)
        assert places.where(sphere._parent(at(fine), fine, coarse) != at(coarse)).count() == 0
        c, reach = sphere._centre(at(fine), fine)
        assert places.where(sphere.angle(c, sphere.unit(F.col("lat"), F.col("lon"))) > reach + 1e-12).count() == 0


def test_what_is_written_grows_as_the_map_does(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    segments = [(float(x), float(y), float(x) + 1.0, float(y)) for x, y in zip(rnd.uniform(-180, 179, 4000), rnd.uniform(-80, 80, 4000))]
    places = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rnd.uniform(-80, 80, 100), rnd.uniform(-180, 180, 100)))]
    written, kept = [], sphere.materialize
    monkeypatch.setattr(sphere, "materialize", lambda df, name: written.append(kept(df, name)) or written[-1])
    got = sphere.nearest_segment_km(spark.createDataFrame(places, PLACES), spark.createDataFrame(segments, SEGMENTS))
    assert got.where("geodesic_km IS NOT NULL").count() == len(places)
    assert sum(df.count() for df in written) < 5 * len(segments)
