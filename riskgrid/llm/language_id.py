"""Language of a text, by rank-order profiles of character n-grams.

A profile lists the ``PROFILE`` most frequent n-grams (one to three characters, within words padded by a
blank), most frequent first, ties by the n-gram's code. The learned languages' profiles come from all texts of
that language whose id is not held out: every task counts its own n-grams first, so what is shuffled
is one row for each task, language and n-gram, however large a language is. A text is compared by
the out-of-place distance: for each n-gram of its profile, how far its rank is from the language's, or ``PROFILE`` if
the language does not list it. The nearest language wins, ties go to the first by name; the score is 1 minus the
distance's share of the largest possible one.

Words are runs of letters and marks, in lower case; everything else separates them. A text that is null or has no
letter, or any text if nothing could be learned, is ``und`` with score 0. Very long texts are read whole. Rows are
judged one by one, so repeated rows, ties and null ids pass through; a null id is in no fold: its text is not
learned from, and ``held_out`` is null. A language is any non-null value, the empty string included. Empty tables give
an empty result; extra columns are ignored.

Profiles are a fitted model: up to ``MODEL_ITEMS`` of them go to the tasks as literals, after a count. More (thousands of
languages) are joined to the texts' n-grams by shuffle, with equal results.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskgrid.llm.common import KEY, arrow_map, key_columns, key_match, materialize

#: Ranks of a profile.
PROFILE = 300
#: N-grams that a task keeps before it hands its counts on.
KEPT = 1_000_000
#: Ranks (languages times ``PROFILE``) that go to the tasks as literals.
MODEL_ITEMS = 1_000_000
UNKNOWN = "und"
#: Stands for the blank around words; no text's letter has this code.
BLANK = 1
BITS = 21


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(id_col.cast("string")), F.lit(5)) == 0


@lru_cache(1)
def letters() -> np.ndarray:
    """By code point: 2 for a letter, 1 for a mark, 0 for all else."""
    kind = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        kind[code] = {"L": 2, "M": 1}.get(unicodedata.category(chr(code))[0], 0)
    return kind


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of a text, in order of size; none without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = letters()[codes]
    if not (kind == 2).any():
        return np.zeros(0, np.int64)
    word = np.concatenate([[False], kind > 0, [False]])
    c = np.where(word, np.concatenate([[0], codes, [0]]), BLANK).astype(np.int64)
    keep = word.copy()
    keep[:-1] |= word[1:]  # the blank before a word, and after the last one
    keep[np.flatnonzero(word)[-1] + 1] = True
    c = c[keep]
    two = c[:-1] << BITS | c[1:]
    three = two[:-1] << BITS | c[2:]
    return np.concatenate([c[c != BLANK], two, three[c[1:-1] != BLANK]])


def profile(text: str | None) -> np.ndarray:
    """The text's n-grams by rank."""
    found, n = np.unique(grams(text), return_counts=True)
    return found[np.argsort(-n, kind="stable")[:PROFILE]]


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, rank`` (from 0), written."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(list)

        def merged() -> int:
            for lang, parts in held.items():
                if len(parts) > 1:
                    g, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                    n = np.zeros(len(g), np.int64)
                    np.add.at(n, at, np.concatenate([p[1] for p in parts]))
                    held[lang] = [(g, n)]
            return sum(len(p[0][0]) for p in held.values())

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, ((g, n),) in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], names=["lang", "gram", "n"])
            held.clear()

        loose = 0
        for batch in batches:
            by_lang: dict = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang[lang].append(grams(text))
            for lang, parts in by_lang.items():
                held[lang].append(np.unique(np.concatenate(parts), return_counts=True))
                loose += len(held[lang][-1][0])
            if loose > KEPT:
                loose = merged()
                if loose > KEPT // 2:
                    yield from rows()
                    loose = 0
        merged()
        yield from rows()

    known = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = arrow_map(known.where("text IS NOT NULL"), count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return materialize(counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < PROFILE).select("lang", "gram", "rank"), "language-profiles")


class Model:
    """All profiles as one sorted list of n-grams, with the ranks of each language."""

    def __init__(self, rows: list):
        self.langs = sorted({r["lang"] for r in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        rows = sorted(rows, key=lambda r: r["gram"])
        self.grams = np.array([r["gram"] for r in rows], np.int64)
        self.lang = np.array([number[r["lang"]] for r in rows], np.int64)
        self.rank = np.array([r["rank"] for r in rows], np.int64)

    def predict(self, text: str | None) -> tuple[str, float]:
        own = profile(text)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        first, end = (np.searchsorted(self.grams, own, side) for side in ("left", "right"))
        n = end - first
        rank = np.repeat(np.arange(len(own)), n)
        at = np.arange(len(rank)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        near = np.zeros(len(self.langs), np.int64)
        np.add.at(near, self.lang[at], PROFILE - np.abs(rank - self.rank[at]))
        best = int(near.argmax())  # the least distance; the first of equals
        return self.langs[best], float(near[best]) / (PROFILE * len(own))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row."""
    profiles = learn(docs, id_col, text_col, lang_col)
    if profiles.count() > MODEL_ITEMS:
        return by_join(docs, profiles, id_col, text_col)
    model = Model(profiles.collect())
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                             names=["doc_id", "lang_pred", "score"])

    out = arrow_map(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")), run, f"doc_id {id_type}, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def by_join(docs: DataFrame, profiles: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The same for any number of languages: profiles meet the texts' n-grams by shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [profile(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.list_(pa.int64()))], names=[*KEY, "grams"])

    rows = docs.select(*key_columns(id_col, text_col), F.col(text_col).cast("string").alias("text"))
    own = materialize(arrow_map(rows, run, f"{KEY[0]} {id_type}, {KEY[1]} long, grams array<long>").dropDuplicates(list(KEY)), "language-own")
    ranked = own.select(*KEY, F.posexplode("grams").alias("own_rank", "gram"))
    near = ranked.join(profiles, "gram").groupBy(*KEY, "lang").agg(F.sum(PROFILE - F.abs(F.col("own_rank") - F.col("rank"))).alias("near"))
    best = near.groupBy(*KEY).agg(F.min_by(F.struct("lang", "near"), F.struct(-F.col("near"), F.col("lang"))).alias("best"))
    best = best.withColumnsRenamed({k: f"near{k}" for k in KEY})
    first = profiles.select(F.min("lang")).scalar()  # no n-gram in common with any language: all are equally far
    judged = own.join(best, F.col(KEY[0]).eqNullSafe(F.col(f"near{KEY[0]}")) & (F.col(KEY[1]) == F.col(f"near{KEY[1]}")), "left").select(
        *KEY, F.when(F.size("grams") > 0, F.coalesce("best.lang", first)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.size("grams") > 0, F.coalesce("best.near", F.lit(0)) / (PROFILE * F.size("grams"))).otherwise(0.0).alias("score"))
    rows = docs.select(*key_columns(id_col, text_col))
    return rows.join(judged, key_match(rows, judged), "left").select(
        rows[KEY[0]].alias("doc_id"), held_out(rows[KEY[0]]).alias("held_out"), "lang_pred", "score")
