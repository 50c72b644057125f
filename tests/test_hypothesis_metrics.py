"""Property tests (hypothesis): AP and the F1-optimal threshold equal a direct
computation on arbitrary score/label lists with heavy ties, on both prefix-sum plans."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

scores_labels = st.lists(st.tuples(st.integers(0, 12).map(lambda v: v / 12), st.integers(0, 1)),
                         min_size=2, max_size=120)


def brute_ap(pairs):
    P = sum(y for _, y in pairs)
    if P == 0:
        return None
    ap, tp, seen = 0.0, 0, 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        grp = [y for x, y in pairs if x == s]
        tp += sum(grp)
        seen += len(grp)
        ap += sum(grp) / P * tp / seen
    return ap


def brute_best(pairs):
    P = sum(y for _, y in pairs)
    best = None
    for t in sorted({s for s, _ in pairs}):
        tp = sum(1 for s, y in pairs if s >= t and y == 1)
        fp = sum(1 for s, y in pairs if s >= t and y == 0)
        f1 = 2 * tp / (tp + fp + P)
        if best is None or f1 > best[1] or (f1 == best[1] and t > best[0]):
            best = (t, f1)
    return best


@pytest.mark.parametrize("path", ["one", "many"])
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=scores_labels)
def test_ap_and_threshold_match_direct_computation(spark, monkeypatch, path, pairs):
    from riskgrid.operators import ranking
    from riskgrid.operators.metrics import average_precision
    from riskgrid.operators.planned import best_thresholds
    monkeypatch.setattr(ranking, "ROWS_PER_RANGE", 1_000_000 if path == "one" else 3)
    df = spark.createDataFrame([("r", "g", float(s), y) for s, y in pairs],
                               "run string, region string, score double, label int")
    got = average_precision(df, ["run"], buckets=4).collect()[0]["ap"]
    want = brute_ap(pairs)
    assert (got is None) if want is None else got == pytest.approx(want, rel=1e-12)
    rows = best_thresholds(df).collect()
    b = brute_best(pairs)
    if sum(y for _, y in pairs) == 0:
        assert rows == []
    else:
        assert rows[0]["threshold"] == pytest.approx(b[0]) and rows[0]["f1"] == pytest.approx(b[1])
