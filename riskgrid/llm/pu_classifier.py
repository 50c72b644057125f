"""Quality classifier by positive-unlabelled learning.

Trusted positives P are rows labelled 1 outside the held-out fold; all web text is the unlabelled
set U. With the class prior ``pi`` and the logistic loss l, the weights minimise

    pi * E_P[l(g)] + max(0, E_U[l(-g)] - pi * E_P[l(-g)])

the non-negative unbiased risk; the second term estimates the risk of the negatives. Each Newton
step is one distributed pass that sums gradient and curvature over all rows; a step after which
the second term would be below zero, or the risk higher, is halved.

Inputs are measures of the whole text and lexical measures: how much likelier its distinct words
and word pairs (hashed into ``BUCKETS``) are in P than in U. The counts of buckets come from all
rows; a row is judged by the counts of the other folds of texts, so neither its own words nor its
own label are among them (copies share a fold).

The prior is estimated from P and U alone, labelled negatives are not read. For any score and
any threshold t, pi is at most the share of U above t over the share of P above t; the bound is
near where the best-scored rows are positives. A fit with a neutral prior gives the first scores,
then prior and fit are renewed until the prior rests. The threshold is the one with the smallest
bound after an allowance for chance; both shares are histograms over all rows.

All sums are exact: inputs, weights and summands are rounded to fixed binary places, so that
results depend neither on the order of rows nor on how they are split into tasks.

The score is the probability of label 1 from the text alone. Labels, language,
source and id are no inputs. Null and empty texts have the measures of an empty text. Very long texts
are measured whole, one text at a time. Repeated
labels of one id count once, and only if they agree. Without trusted positives nothing is known
of either class and every score is 0.5. Repeated rows and null ids pass through (a null id has no label; it is not held out).
Empty tables give empty tables. Extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, arrow_map, if_small, key_columns, materialize

FOLDS = 5
THRESHOLD = 0.3
STEPS = 20
#: Weight of the squared weights, beside 16 over the number of positives: a few positives allow no large weights.
RIDGE = 1e-4
SYMBOLS = "#*$%&<>{}[]\\/_=~^@"
#: Buckets of hashed words and word pairs, and folds of texts that do not see their own counts.
BUCKETS = 1 << 14
TEXT_FOLDS = 4
#: Rows added to a bucket's count in P and to the count that its share of U lets expect: rare buckets tell little.
SMOOTHING = 1.0
#: Bins of the score, rounds, and the chance of error of the prior's estimate.
BINS = 512
PRIOR_ROUNDS = 4
CHANCE = 0.1
#: Binary places of inputs, standardised inputs, probabilities, weights, and of the sums made of them.
X_BITS, Z_BITS, S_BITS, W_BITS, SUM_BITS = 12, 8, 12, 20, 28
#: Rows summed at once as doubles without loss.
EXACT_ROWS = 1024


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(text: str) -> list[float]:
    """Measures of a whole text, each of a bounded or logarithmic range."""
    words = text.split()
    n, chars = max(len(words), 1), max(len(text), 1)
    counted = Counter(words)
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    bigrams = Counter(zip(words, words[1:]))
    upper, letters = sum(map(str.isupper, text)), max(sum(map(str.isalpha, text)), 1)
    sizes = Counter(map(len, words))
    mean = sum(k * v for k, v in sizes.items()) / n
    values = [
        math.log1p(len(words)), min(mean, 30) / 10, math.log1p(max(sizes, default=0)), len(counted) / n,
        max(counted.values(), default=0) / n, sum(a == b for a, b in zip(words, words[1:])) / n,
        1 - len(bigrams) / max(len(words) - 1, 1), upper / letters, min(text.count("!") / n, 1), min(text.count("|") / n, 1),
        sum(text.count(c) for c in SYMBOLS) / chars, sum(map(str.isdigit, text)) / chars,
        min(sum(text.count(c) for c in ".?") / n, 1), min(text.count(",") / n, 1), math.log1p(len(lines)),
        1 - len(set(lines)) / max(len(lines), 1), math.log1p(len(words) / max(len(lines), 1)),
        sum(v for k, v in sizes.items() if k == 1) / n, sum(w[0].isupper() for w in words) / n, float(len(words) < 15),
        float(len(words) < 5), min((chars - letters) / chars, 1)]
    # Saturating copies of the measures of which a little already tells much.
    return values + [math.tanh(20 * values[i]) for i in (4, 5, 6, 7, 8, 9, 10, 11, 15)] + [v * v for v in values[:7]]


N_MEASURES = len(features(""))
N_LEXICAL = 3
N_FEATURES = N_MEASURES + N_LEXICAL


def _rounded(x, bits: int):
    """Rounded to so many binary places."""
    return np.rint(np.ldexp(x, bits)) * 2.0**-bits


class Buckets:
    """The distinct buckets of a text's words and neighbouring word pairs, in order."""

    def __init__(self, most: int = 200_000):
        self.seen, self.most = {}, most

    def __call__(self, text: str) -> np.ndarray:
        if len(self.seen) > self.most:
            self.seen = {}
        seen, words = self.seen, text.lower().split()
        for w in set(words):
            if w not in seen:
                seen[w] = zlib.crc32(w.encode("utf-8", "surrogatepass"))
        h = np.array([seen[w] for w in words], np.uint64)
        pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
        there = np.zeros(BUCKETS, bool)
        there[(h & np.uint64(BUCKETS - 1)).astype(np.int64)] = True
        there[(pairs >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)] = True
        return np.flatnonzero(there)


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: key, measures ``x`` and distinct ``buckets``."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets()
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            x = [_rounded(np.array(features(t)), X_BITS) for t in texts]
            found = [buckets(t) for t in texts]
            ends = np.cumsum([0, *map(len, found)])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *found]), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(x, pa.list_(pa.float32())), ids], names=[*KEY, "x", "buckets"])

    rows = docs.select(*key_columns(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, run, f"{KEY[0]} {id_type}, {KEY[1]} long, x array<float>, buckets array<int>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Items of a list column, and the row of each."""
    sizes = np.array([len(v) for v in column], np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def bucket_evidence(marked: DataFrame) -> np.ndarray:
    """Per fold of texts and bucket: log of its count in P over the count that its share of U lets expect, from the other folds' rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last place of each fold and class counts its rows.
        total = np.zeros(TEXT_FOLDS * 2 * (BUCKETS + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                fold = np.mod(batch.column(0).to_numpy(zero_copy_only=False), TEXT_FOLDS)
                p = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                ids, at = _lists(batch.column(2))
                for kind, chosen in ((0, np.ones(len(p), bool)), (1, p)):
                    base = (fold * 2 + kind) * (BUCKETS + 1)
                    total += np.bincount((base[at] + ids)[chosen[at]], minlength=len(total))
                    total += np.bincount((base + BUCKETS)[chosen], minlength=len(total))
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(total[filled], pa.int64())], names=["i", "v"])

    parts = marked.select(KEY[1], "p", "buckets").mapInArrow(run, "i int, v long").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    counts = np.zeros(TEXT_FOLDS * 2 * (BUCKETS + 1), np.int64)
    counts[parts["i"].to_numpy(np.int64)] = parts["v"].to_numpy(np.int64)
    counts = counts.reshape(TEXT_FOLDS, 2, BUCKETS + 1)
    others = counts.sum(0) - counts
    u, p = others[:, 0, :BUCKETS], others[:, 1, :BUCKETS]
    expected = u * (others[:, 1, BUCKETS:] / np.maximum(others[:, 0, BUCKETS:], 1))
    return _rounded(np.clip(np.log((p + SMOOTHING) / (expected + SMOOTHING)), -4, 4), X_BITS)


def with_lexical(marked: DataFrame, evidence: np.ndarray) -> DataFrame:
    """Key, p, and ``x`` with the lexical measures: mean evidence, mean of what speaks against P, share of strong evidence against it."""
    id_type = marked.schema[KEY[0]].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            fold = np.mod(batch.column(1).to_numpy(zero_copy_only=False), TEXT_FOLDS)
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(n, N_MEASURES).astype(float)
            ids, at = _lists(batch.column(3))
            told = evidence[fold[at], ids]
            size = np.maximum(np.bincount(at, minlength=n), 1)
            lexical = [np.bincount(at, v, minlength=n) / size for v in (told, np.minimum(told, 0), (told < -1).astype(float))]
            x = np.hstack([x, _rounded(np.stack(lexical, 1) * [5, 5, 10], X_BITS)]) if n else np.empty((0, N_FEATURES))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * N_FEATURES, pa.int32()), pa.array(x.ravel(), pa.float32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists, batch.column(4)], names=[*KEY, "x", "p"])

    return marked.select(*KEY, "x", "buckets", "p").mapInArrow(run, f"{KEY[0]} {id_type}, {KEY[1]} long, x array<float>, p boolean")


def summed(rows: DataFrame, fn, size: int, bits: int = SUM_BITS) -> np.ndarray:
    """The sum over all rows of what ``fn(x, p)`` sums for a batch: a vector of ``size`` multiples of 2**-bits, exact."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            if batch.num_rows:
                x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(float)
                p = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
                for k in range(0, len(x), EXACT_ROWS):
                    total += np.rint(np.ldexp(fn(x[k:k + EXACT_ROWS], p[k:k + EXACT_ROWS]), bits)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], names=["i", "v"])

    # A task's sum fits 64 bits; that over all tasks is a decimal.
    parts = rows.select("x", "p").mapInArrow(run, "i int, v long").groupBy("i").agg(F.sum(F.col("v").cast("decimal(20,0)")).alias("v")).collect()
    out = np.zeros(size)
    for r in parts:
        out[r["i"]] = math.ldexp(int(r["v"]), -bits)
    return out


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _logistic(g: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(g, -500, 500)))


class Model:
    """Weights on standardised inputs; the last weight is the constant."""

    def __init__(self, mean, scale, weights, prior):
        self.mean, self.scale, self.weights, self.prior = mean, scale, _rounded(weights, W_BITS), prior

    def design(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([_rounded(np.clip((x - self.mean) / self.scale, -8, 8), Z_BITS), np.ones((len(x), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.design(x) @ self.weights)


def standardised(rows: DataFrame) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Numbers of rows and of positives, means and deviations of the inputs."""
    v = summed(rows, lambda x, p: np.concatenate([[len(x), p.sum()], x.sum(0), (x * x).sum(0)]), 2 + 2 * N_FEATURES, 2 * X_BITS)
    n = max(v[0], 1)
    mean = v[2:2 + N_FEATURES] / n
    return int(v[0]), int(v[1]), mean, np.sqrt(np.maximum(v[2 + N_FEATURES:] / n - mean**2, 1e-8))


def fit(rows: DataFrame, prior: float, basis=None, start: Model | None = None) -> Model:
    """``rows``: x, and p (whether a trusted positive). All rows count as unlabelled. ``basis``: of :func:`standardised`, if known."""
    d = N_FEATURES + 1
    n, n_p, mean, scale = basis or standardised(rows)
    weights = np.zeros(d)
    weights[-1] = math.log(prior / (1 - prior))
    model = Model(mean, scale, weights, prior)
    if not n_p:
        return model

    strength = RIDGE + 16 / n_p

    def at(now: Model):
        def sums(x, p):
            z = now.design(x)
            g = z @ now.weights
            s = _logistic(g)
            curve = _rounded(s * (1 - s), S_BITS)
            return np.concatenate([
                [_rounded(_softplus(g), SUM_BITS).sum(), _rounded(_softplus(g[p]), SUM_BITS).sum(), _rounded(_softplus(-g[p]), SUM_BITS).sum()],
                z[p].sum(0), _rounded(s, SUM_BITS - Z_BITS) @ z, ((z * curve[:, None]).T @ z).ravel()])

        v, w = summed(rows, sums, 3 + 2 * d + d * d), now.weights
        negative = v[0] / n - prior * v[1] / n_p
        risk = prior * v[2] / n_p + max(0.0, negative) + strength / 2 * (w[:-1] ** 2).sum()
        ridge = np.append(np.full(d - 1, strength), 1e-9)
        gradient = v[3 + d:3 + 2 * d] / n - prior * v[3:3 + d] / n_p + ridge * w
        return negative, risk, gradient, v[3 + 2 * d:].reshape(d, d) / n + np.diag(ridge)

    negative, risk, gradient, curvature = at(model)
    if start is not None:
        # Another prior's fit is a start only if it is allowed and better.
        other = at(Model(mean, scale, start.weights, prior))
        if other[0] >= 0 and other[1] <= risk:
            model, (negative, risk, gradient, curvature) = Model(mean, scale, start.weights, prior), other
    for _ in range(STEPS):
        step = np.linalg.solve(curvature, gradient)
        if step @ gradient < 1e-9:
            break
        for _ in range(8):
            tried = Model(mean, scale, model.weights - step, prior)
            trial = at(tried)
            if trial[0] >= 0 and trial[1] <= risk:
                break
            step = step / 2
        else:
            break
        model = tried
        gained, (negative, risk, gradient, curvature) = risk - trial[1], trial
        if gained < 1e-6:
            break
    return model


def prior_bound(u: np.ndarray, p: np.ndarray) -> float:
    """The class prior from histograms of the scores of U and P: share of U over share of P above the best threshold."""
    n_u, n_p = u.sum(), p.sum()
    over_u, over_p = np.cumsum(u[::-1]) / n_u, np.cumsum(p[::-1]) / n_p
    slack = math.sqrt(math.log(4 / CHANCE) / (2 * n_u)) + math.sqrt(math.log(4 / CHANCE) / (2 * n_p))
    with np.errstate(divide="ignore", invalid="ignore"):
        bound = np.where(over_p > 0, (over_u + slack) / over_p, np.inf)
    best = int(np.argmin(bound))
    # The trusted positives are rows of U themselves.
    return float(np.clip(over_u[best] / over_p[best], n_p / (n_u + 1), n_u / (n_u + 1)))


def learn(rows: DataFrame) -> Model:
    """Prior and weights in turn, from a neutral prior."""
    basis = standardised(rows)
    model = fit(rows, 0.5, basis)
    if not basis[1]:
        return model
    for _ in range(PRIOR_ROUNDS):
        now = model

        def histogram(x, p):
            at = np.minimum((now.score(x) * BINS).astype(np.int64), BINS - 1)
            return np.concatenate([np.bincount(at, minlength=BINS), np.bincount(at[p], minlength=BINS)]).astype(float)

        counts = summed(rows, histogram, 2 * BINS, 0)
        prior = prior_bound(counts[:BINS], counts[BINS:])
        if abs(prior - now.prior) < 0.01:
            break
        model = fit(rows, prior, basis, now)
    return model


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_id: str = "doc_id", label_col: str = "quality", threshold: float = THRESHOLD,
             keyed: bool = False) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row; with ``keyed``, the key columns come first."""
    positives = (labels.where(~held_out(F.col(label_id)) & F.col(label_id).isNotNull() & F.col(label_col).isin(0, 1))
                 .groupBy(F.col(label_id).alias("__id")).agg(F.min(label_col).alias("least")).where("least = 1").select("__id"))
    table = materialize(feature_table(docs, id_col, text_col), "quality-features")
    trusted = if_small(materialize(positives, "trusted-positives"))
    marked = table.join(trusted, table[KEY[0]] == trusted["__id"], "left").select(*KEY, "x", "buckets", F.col("__id").isNotNull().alias("p"))
    rows = materialize(with_lexical(marked, bucket_evidence(marked)), "quality-rows")
    model = learn(rows)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x), pa.float64())], names=[*KEY, "score"])

    scored = rows.select(*KEY, "x").mapInArrow(run, f"{KEY[0]} {id_type}, {KEY[1]} long, score double")
    return scored.select(*KEY[:2 * keyed], F.col(KEY[0]).alias("doc_id"), held_out(F.col(KEY[0])).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
