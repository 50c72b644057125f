"""Quality rules under weak supervision.

Each rule votes good (1) or bad (-1) or abstains (0) on a document's measures. Expectation-
maximisation over the counts of all vote patterns (at most 3^10, whatever the corpus holds)
estimates how accurate each rule's votes are on good and on bad documents, and the share of good
ones. A document is kept if its posterior probability of being good is at least one half, in
place of passing every rule; documents that fail the base test are never kept.

Null and empty texts have no words: all measures 0, base_failed, not kept. Rows are treated one
by one; repeated rows and null ids pass through. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import arrow_map, materialize

WORD = regex.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: Weight of the belief that a rule votes rightly, as a share of the corpus.
TRUST = 0.02
ROUNDS = 100

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
            "n_distinct", "n_top", "n_odd", "n_marks")


def measure(text: str) -> tuple[int, ...]:
    """The MEASURES of one text."""
    words = WORD.findall(text)
    n = len(words)
    counted = Counter(words)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    repeated = 0
    if n >= WINDOW:
        number = {w: i for i, w in enumerate(counted)}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
        # Windows as numbers of pairs of pairs: exact, no hashes.
        same = ids
        pairs = _numbered(same[:-1] * len(counted) + same[1:])
        fours = _numbered(pairs[:-2] * (pairs.max() + 1) + pairs[2:])
        fives = _numbered(fours[:-1] * len(counted) + ids[4:])
        often = np.bincount(fives)[fives] >= 2
        cover = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(often)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + WINDOW, -1)
        repeated = int((np.cumsum(cover[:n]) > 0).sum())
    return (n, sum(map(len, words)), sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated, len(lines),
            sum(map(str.isupper, text)), sum(map(str.isalpha, text)), len(counted), max(counted.values(), default=0),
            sum(not w.strip(".,;:!?'\"()-").isalnum() for w in words), text.count("!") + text.count("|"))


def _numbered(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1]


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measure(t or "") for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in rows.T)], names=["doc_id", *MEASURES])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(rows, run, f"doc_id {id_type}, " + ", ".join(f"{m} long" for m in MEASURES))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The votes. A rule abstains between its two limits, and where there is too little to judge."""
    n, per_word = F.col("n_words"), lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    length, lines = per_word("word_chars"), F.greatest(F.col("n_lines"), F.lit(1))
    upper = F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1))
    return {
        "word_count": _vote(n < MIN_WORDS, n >= 60),
        "word_length": _vote((length < 2.5) | (length > 12), (length >= 3.5) & (length <= 9)),
        "symbols": _vote(per_word("n_symbols") > 0.1, (per_word("n_symbols") <= 0.01) & (n >= 20)),
        "duplicate_lines": _vote(F.col("n_dup_lines") * 10 > lines * 3, (F.col("n_dup_lines") == 0) & (F.col("n_lines") >= 3)),
        "repeated_words": _vote(per_word("n_repeat_words") > 0.1, (per_word("n_repeat_words") <= 0.01) & (n >= 40)),
        "capitals": _vote(upper > 0.4, (upper <= 0.12) & (n >= 20)),
        "variety": _vote((per_word("n_distinct") < 0.15) & (n >= 30) & (n < 5000), (per_word("n_distinct") >= 0.35) & (n >= 30)),
        "top_word": _vote((per_word("n_top") > 0.2) & (n >= 10), (per_word("n_top") <= 0.1) & (n >= 30)),
        "marks": _vote(per_word("n_marks") > 0.15, (per_word("n_marks") <= 0.02) & (n >= 20)),
        "plain_words": _vote((per_word("n_odd") > 0.2) & (n >= 20), (per_word("n_odd") <= 0.05) & (n >= 20)),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], n_rules: int) -> tuple[float, np.ndarray]:
    """EM on pattern counts: the log odds of the prior, and per rule those of votes -1, 0 and 1."""
    votes = np.array([p for p, _ in patterns], int).reshape(-1, n_rules)
    weight = np.array([c for _, c in patterns], float)
    good = np.where((votes < 0).any(axis=1), 0.1, 0.95)  # at first, any vote against makes a document doubtful
    total = weight.sum()
    prior, odds = 0.0, np.zeros((n_rules, 3))
    belief = np.array([[0.6, 0.4], [0.02, 0.98]])  # of votes -1 and 1 on bad and on good documents
    for _ in range(ROUNDS if total else 0):
        share = (good @ weight + 1) / (total + 2)
        prior = math.log(share / (1 - share))
        for r in range(n_rules):
            seen = np.array([[(weight * side)[votes[:, r] == v].sum() for v in (-1, 1)] for side in (1 - good, good)])
            p = seen + belief * (TRUST * total + 1)
            p /= p.sum(axis=1, keepdims=True)
            odds[r, [0, 2]] = np.log(p[1] / p[0])  # abstaining tells nothing
        before, good = good, 1 / (1 + np.exp(-np.clip(prior + sum(odds[r][votes[:, r] + 1] for r in range(n_rules)), -500, 500)))
        if np.abs(before - good).max() < 1e-9:
            break
    return prior, odds


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed``, the posterior ``p_good`` and ``kept``."""
    measured = materialize(measures(docs, id_col, text_col), "quality-measures")
    named = rules()
    votes = measured.select(*[v.cast("int").alias(k) for k, v in named.items()])
    patterns = [(tuple(r[:-1]), r[-1]) for r in votes.groupBy(*named).count().collect()]
    prior, odds = fit(sorted(patterns), len(named))
    score = F.lit(float(prior))
    for (_, vote), o in zip(named.items(), odds):
        score = score + F.when(vote == -1, float(o[0])).when(vote == 1, float(o[2])).otherwise(float(o[1]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return measured.select("*", failed.alias("base_failed"), (1 / (1 + F.exp(-score))).alias("p_good")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("p_good") >= 0.5))
