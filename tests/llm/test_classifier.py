"""The quality classifier: exact sums, lexical measures, the prior from positives and unlabelled text."""

import random

import numpy as np
import pytest

pytest.importorskip("riskgrid.llm")

from riskgrid.llm import pu_classifier as pu  # noqa: E402
from riskgrid.llm.common import KEY  # noqa: E402

DOCS = "doc_id long, text string"
LABELS = "doc_id long, quality int"


def scores(docs, labels):
    return sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.score, r.predicted) for r in pu.classify(docs, labels).collect())


def by_vocabulary(n=600, seed=3):
    """Texts of equal shape, a third of them of class 0: the classes differ in their words alone."""
    rnd = random.Random(seed)
    letters = "bcdfghklmn"
    kinds = [["".join(rnd.choice(letters) for _ in range(5)) for _ in range(150)] for _ in range(2)]
    rows, truth = [], {}
    for i in range(n):
        good = i % 3 > 0
        rows.append((i, " ".join(rnd.choice(kinds[good]) if rnd.random() < 0.7 else rnd.choice(kinds[not good]) for _ in range(40))))
        truth[i] = int(good)
    return rows, truth


def test_words_alone_separate_classes_of_equal_shape(spark):
    rows, truth = by_vocabulary()
    out = pu.classify(spark.createDataFrame(rows, DOCS), spark.createDataFrame(list(truth.items()), LABELS)).collect()
    held = [(r.score, truth[r.doc_id]) for r in out if r.held_out]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert len(good) > 20 and len(bad) > 20
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_labelled_negatives_are_not_read(spark):
    rows, truth = by_vocabulary(200)
    docs = spark.createDataFrame(rows, DOCS)
    assert scores(docs, spark.createDataFrame(list(truth.items()), LABELS)) == scores(docs, spark.createDataFrame([x for x in truth.items() if x[1]], LABELS))


def test_scores_do_not_depend_on_order_or_tasks(spark):
    rows, truth = by_vocabulary(300)
    rows += [(None, rows[0][1]), (5, rows[5][1]), (900, None), (901, "")]
    labels = spark.createDataFrame(list(truth.items()), LABELS)
    want = scores(spark.createDataFrame(rows, DOCS).coalesce(1), labels)
    random.Random(1).shuffle(rows)
    assert scores(spark.createDataFrame(rows, DOCS).repartition(7), labels) == want


def test_a_text_does_not_see_its_own_counts(spark):
    rows, truth = by_vocabulary(60)
    marked = pu.feature_table(spark.createDataFrame(rows, DOCS), "doc_id", "text").selectExpr(*KEY, "x", "buckets", f"{KEY[0]} % 3 > 0 AS p")
    got = pu.bucket_evidence(marked)
    docs = [(r[KEY[1]] % pu.TEXT_FOLDS, r.buckets, r.p) for r in marked.collect()]
    for fold in range(pu.TEXT_FOLDS):
        others = [(b, p) for f, b, p in docs if f != fold]
        u, p = np.zeros(pu.BUCKETS), np.zeros(pu.BUCKETS)
        for b, positive in others:
            u[b] += 1
            p[b] += positive
        want = np.log((p + pu.SMOOTHING) / (u * sum(q for _, q in others) / len(others) + pu.SMOOTHING))
        assert np.abs(got[fold] - np.clip(want, -4, 4)).max() <= 2.0**-pu.X_BITS


@pytest.mark.parametrize("prior", [0.2, 0.5, 0.9])
def test_prior_of_mixtures(prior):
    rnd = np.random.default_rng(2)
    at = lambda s: np.bincount((np.clip(s, 0, 0.999) * pu.BINS).astype(int), minlength=pu.BINS)
    n = 40_000
    positive = rnd.random(n) < prior
    s = np.where(positive, rnd.beta(6, 2, n), rnd.beta(2, 6, n))
    trusted = positive & (rnd.random(n) < 0.3)
    assert abs(pu.prior_bound(at(s), at(s[trusted])) - prior) < 0.06


def test_edge_rows(spark):
    rows, truth = by_vocabulary(120)
    long = " ".join(t for _, t in rows) * 40
    docs = spark.createDataFrame(rows + [(500, None), (501, ""), (502, long), (None, rows[1][1]), (1, rows[1][1]), (503, "퟿ \U0001f600 x")], DOCS)
    labels = spark.createDataFrame([*truth.items(), (1, 1), (2, 0), (None, 1), (700, 1), (4, None)], LABELS)
    out = {}
    for r in pu.classify(docs, labels).collect():
        out.setdefault(r.doc_id, []).append((r.held_out, r.score, r.predicted))
    assert len(out[1]) == 2 and out[1][0] == out[1][1] and out[None][0][1:] == out[1][0][1:] and out[None][0][0] is False
    assert out[500][0][1:] == out[501][0][1:]
    assert all(0 <= s <= 1 and k == (s >= pu.THRESHOLD) for v in out.values() for _, s, k in v) and sum(map(len, out.values())) == 126


def test_without_trusted_positives_every_score_is_one_half(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, None)], DOCS)
    assert {r.score for r in pu.classify(docs, spark.createDataFrame([(1, 0)], LABELS)).collect()} == {0.5}
    assert pu.classify(docs.limit(0), spark.createDataFrame([(1, 1)], LABELS)).count() == 0


def test_sums_are_exact_and_large(spark):
    x = [float(np.float32(pu._rounded(v, pu.X_BITS))) for v in np.random.default_rng(1).normal(0, 9, 5000)]
    rows = spark.createDataFrame([([v] * pu.N_FEATURES, i % 2 == 0) for i, v in enumerate(x)], "x array<float>, p boolean")
    want = sum(int(v * 2**pu.X_BITS) for v in x) / 2**pu.X_BITS
    for parts in (1, 5):
        got = pu.summed(rows.repartition(parts), lambda a, p: np.array([a[:, 0].sum(), p.sum()]), 2, 2 * pu.X_BITS)
        assert got.tolist() == [want, 2500]
