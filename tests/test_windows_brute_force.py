"""Window features and label against a direct per-day recomputation on random catalogs
(nulls, NaN, silent gaps, an out-of-list region stretching the calendar)."""

import datetime as dt
import math
import random

import pytest

from riskgrid.operators.grid import daily_grid, daily_tally, gap_filled_tally
from riskgrid.operators.windows import as_feature_table, window_features
from riskgrid.schema import Region
from riskgrid.session import materialize

REGS = [Region("a", 5.0), Region("b", 4.0), Region("c", 6.0)]
TH = {r.name: r.threshold for r in REGS}


def _catalog(seed):
    rnd = random.Random(seed)
    d0 = dt.date(2021, 1, 1)
    rows = []
    for reg in ("a", "b", "c"):
        for day in range(120):
            if 40 <= day < 86 and reg == "b":
                continue                      # a 46-day silence
            if rnd.random() < 0.45:
                continue                      # quiet day
            for _ in range(rnd.randint(1, 4)):
                mag = rnd.choice([float("nan"), None] + [round(rnd.uniform(2, 7), 2)] * 8)
                depth = rnd.choice([None] + [round(rnd.uniform(-3, 60), 2)] * 5)
                rows.append((reg, d0 + dt.timedelta(days=day + 5), mag, depth,
                             round(rnd.uniform(-50, 50), 2), round(rnd.uniform(-150, 150), 2),
                             round(rnd.uniform(0, 900), 3)))
    rows.append(("zz", d0 + dt.timedelta(days=140), 9.9, 1.0, 0.0, 0.0, 1.0))   # stretches calendar
    rows.append(("zz", d0, 1.0, 1.0, 0.0, 0.0, 1.0))
    return rows


def _mean(vals, n):
    return None if n == 0 else sum(vals) / n


def _expected(rows):
    days = sorted({r[1] for r in rows})
    lo, hi = days[0], days[-1]
    cal = [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]
    out = {}
    for reg in TH:
        ev = [r for r in rows if r[0] == reg]
        by_day = {}
        for r in ev:
            by_day.setdefault(r[1], []).append(r)
        last = None
        n7s = []
        for i, d in enumerate(cal):
            def window(k):
                return [r for j in range(max(0, i - k + 1), i + 1) for r in by_day.get(cal[j], [])]
            w7, w30 = window(7), window(30)
            mag = lambda r: None if r[2] is None or (isinstance(r[2], float) and math.isnan(r[2])) else r[2]
            nz = lambda xs: [x for x in xs if x is not None]
            if by_day.get(d):
                last = d
            n7, n30 = len(w7), len(w30)
            n7s.append(n7)
            fut = cal[i + 1:i + 8]
            label = None
            if len(fut) == 7:
                label = int(any(mag(r) is not None and mag(r) >= TH[reg] for f in fut for r in by_day.get(f, [])))
            mx = nz([mag(r) for r in w30])
            out[(reg, d)] = {
                "quakes_7d": n7, "quakes_30d": n30,
                "large_30d": sum(1 for r in w30 if mag(r) is not None and mag(r) >= TH[reg]),
                "avg_mag_7d": _mean(nz([mag(r) for r in w7]), n7),
                "avg_mag_30d": _mean(nz([mag(r) for r in w30]), n30),
                "max_mag_30d": max(mx) if mx else None,
                "avg_depth_30d": _mean(nz([r[3] for r in w30]), n30),
                "centroid_lat_30d": _mean([r[4] for r in w30], n30),
                "avg_dist_30d": _mean([r[6] for r in w30], n30),
                "trend_7d": None if i < 7 else n7 - n7s[i - 7],
                "days_since_last": None if last is None else (d - last).days,
                "label_7d": label,
            }
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_direct_recomputation(spark, seed):
    rows = _catalog(seed)
    df = spark.createDataFrame(rows, "region string, date date, magnitude double, depth_km double, "
                                     "latitude double, longitude double, distance_to_fault_km double")
    tally = materialize(daily_tally(df, REGS), "t")
    got = as_feature_table(window_features(gap_filled_tally(daily_grid(spark, tally, REGS), tally))).collect()
    want = _expected(rows)
    assert len(got) == len(want)
    for r in got:
        exp = want[(r["region"], r["date"])]
        for k, v in exp.items():
            if v is None:
                assert r[k] is None, (r["region"], r["date"], k)
            else:
                assert r[k] == pytest.approx(v, rel=1e-9, abs=1e-9), (r["region"], r["date"], k)
