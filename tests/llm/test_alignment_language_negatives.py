"""Cross-tokenizer alignment, language identification and hard negatives against brute force, and their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("riskgrid.llm")

from riskgrid.llm import alignment, hard_negatives, language_id, queries  # noqa: E402

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PATHS = queries.vocabulary(), queries.vocabulary("piece_bpe_32k.model")
ODD = [" ", "  ", "\n", "\t", "a", "the", " house", "é", "▁", "<|endoftext|>", "<s>", "x1", "99", "'s", " ", "　", "漢字", "😀", "\r\n", "\x00", "!!", "\x85", "\x1c", "ﬁ", "é"]


def edge_texts():
    rnd = random.Random(2)
    made = ["".join(rnd.choice(ODD) for _ in range(rnd.randint(0, 25))) for _ in range(600)]
    return [*made, None, "", " ", "  ", "a" * 3000, "😀" * 400, " ".join(made)[:40_000].replace("▁", ""), made[0], made[0]]


# ---------------------------------------------------------------------------
# Alignment
# ---------------------------------------------------------------------------

def aligned_by_brute_force(texts):
    """Every text encoded whole by the libraries; groups from the set of shared ends; links by overlap."""
    v = alignment.vocabularies(*PATHS)
    rows, links, corpus = [], [], Counter()
    for t in texts:
        a = v.tok.encode(f" {t}", add_special_tokens=False).ids if t else []
        b = v.sp.encode(t) if t else []
        whole = f" {t}".encode()
        if not t or b"".join(v.bytes_a[i] for i in a) != whole or b"".join(v.bytes_b[i] for i in b) != whole:
            rows.append((0, 0, 0, 0, "")), links.append([])
            continue
        ends_a, ends_b = (np.cumsum([0] + [len(table[i]) for i in ids]).tolist() for table, ids in ((v.bytes_a, a), (v.bytes_b, b)))
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends_a[1:]) & set(ends_b[1:])):
            ni, nj = ends_a.index(cut), ends_b.index(cut)
            groups.append(",".join(map(str, a[i:ni])) + "|" + ",".join(map(str, b[j:nj])))
            i, j = ni, nj
        own, j = [], 0
        for i in range(len(a)):
            while ends_b[j + 1] <= ends_a[i]:
                j += 1
            k = j
            while k < len(b) and ends_b[k] < ends_a[i + 1]:
                own.append((a[i], b[k]))
                k += 1
        corpus.update(own)
        links.append(own)
        rows.append((len(a), len(b), len(groups), len(own), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (a, b), n in corpus.items():
        most[b] = max(most[b], n)
    return [(*r[:4], sum(corpus[p] == most[p[1]] for p in own), sum(corpus[p] for p in own), r[4]) for r, own in zip(rows, links)]


def aligned(docs):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                  for r in alignment.align(docs, *PATHS).collect())


@pytest.mark.parametrize("sent", [alignment.PAIRS_SENT, 0])
def test_alignment_equals_brute_force_on_odd_texts(spark, monkeypatch, sent):
    monkeypatch.setattr(alignment, "PAIRS_SENT", sent)
    texts = edge_texts()
    docs = spark.createDataFrame([(i, t, "n", "x") for i, t in enumerate(texts)], "doc_id long, text string, n string, row string").repartition(3)
    assert aligned(docs) == sorted((i, *r) for i, r in enumerate(aligned_by_brute_force(texts)))


def test_alignment_equals_brute_force_on_documents(spark, monkeypatch):
    monkeypatch.setattr(alignment, "WORD_BYTES", 200_000)  # tables start anew often
    monkeypatch.setattr(alignment, "RUN_BYTES", 50_000)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    assert aligned(docs) == sorted((r.doc_id, *x) for r, x in zip(rows, aligned_by_brute_force([r.text for r in rows])))


def test_whole_texts_are_encoded_where_words_cannot_be(monkeypatch):
    v = alignment.Vocabularies(*PATHS)
    texts = [t for t in edge_texts() if t]
    by_word = v.encode(texts)
    v.by_word = False
    v.forget()
    assert all(np.array_equal(x, y) for x, y in zip(by_word, v.encode(texts)))


def test_shared_cuts_are_all_found():
    rnd = random.Random(4)
    for _ in range(300):
        ends, first, total = [[], []], [0], 0
        for _ in range(rnd.randint(1, 4)):
            n = rnd.randint(1, 120)
            for k in (0, 1):
                dense = rnd.choice([0.02, 0.2, 0.9])
                ends[k] += [total + i for i in range(1, n) if rnd.random() < dense] + [total + n]
            total += n
            first.append(len(ends[0]))
        a, b = (np.array(e) for e in ends)
        assert np.array_equal(alignment.shared_cuts(a, b, np.array(first)), np.isin(a, b))


def test_alignment_of_null_ids_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "one two"), (1, "one two"), (1, "one two"), (2, None)], "doc_id long, text string")
    rows = aligned(docs)
    assert [r[0] for r in rows] == [-1, 1, 1, 2] and len({r[1:] for r in rows[:3]}) == 1
    assert rows[0][6] == 3 * rows[0][4] and rows[0][5] == rows[0][4]  # each copy's links count
    assert rows[3][1:] == (0, 0, 0, 0, 0, 0, "")
    assert aligned(docs.limit(0)) == []


# ---------------------------------------------------------------------------
# Language
# ---------------------------------------------------------------------------

def gram_list(text):
    import unicodedata

    kinds = [(c, unicodedata.category(c)[0]) for c in (text or "").lower()]
    if all(k != "L" for _, k in kinds):
        return []
    words = "".join(c if k in "LM" else " " for c, k in kinds).split()
    out = []
    for w in words:
        out += list(w) + [f" {w} "[i:i + n] for n in (2, 3) for i in range(len(w) + 3 - n)]
    return out


def order_of(gram):
    """The order of codes: as numbers, the blank as 1."""
    n = 0
    for c in gram:
        n = n << 21 | (1 if c == " " else ord(c))
    return n


def ranked(counts):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], order_of(x[0])))[:language_id.PROFILE]]


def identified_by_brute_force(rows):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows if i is not None}
    counts = defaultdict(Counter)
    for i, text, lang in rows:
        if i is not None and not held[i] and lang is not None and text is not None:
            counts[lang].update(gram_list(text))
    profiles = {lang: {g: r for r, g in enumerate(ranked(c))} for lang, c in counts.items() if c}
    out = []
    for i, text, _ in rows:
        own = ranked(Counter(gram_list(text)))
        if not own or not profiles:
            out.append((i, held.get(i), "und", 0.0))
            continue
        far = {lang: sum(abs(r - p[g]) if g in p else language_id.PROFILE for r, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(far, key=lambda k: (far[k], k))
        out.append((i, held.get(i), best, round(1 - far[best] / (language_id.PROFILE * len(own)), 9)))
    return sorted(out, key=str)


def identified(docs):
    return sorted(((r.doc_id, r.held_out, r.lang_pred, round(r.score, 9)) for r in language_id.identify(docs).collect()), key=str)


@pytest.mark.parametrize("items,kept", [(language_id.MODEL_ITEMS, language_id.KEPT), (0, 50)])
def test_languages_equal_brute_force(spark, monkeypatch, items, kept):
    monkeypatch.setattr(language_id, "MODEL_ITEMS", items)
    monkeypatch.setattr(language_id, "KEPT", kept)
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows += [(None, "The night", "en"), (901, None, "en"), (902, "", "de"), (903, "12 34 !", "de"), (904, "漢字", None), (905, "Nacht und Tag", ""),
             (906, "ǅ İstanbul é", "tr"), (907, "ßß", "de"), (907, "ßß", "de"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("gram", F.lit("x")).withColumn("n", F.lit(1))
    assert identified(docs) == identified_by_brute_force(rows)


def test_language_without_training_rows_and_without_rows(spark):
    docs = spark.createDataFrame([(1, "some words", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert [r[2:] for r in identified(docs)] == [("und", 0.0)] * 2
    assert identified(docs.limit(0)) == []


def test_language_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    out = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*")).first()
    assert n > 150 and right > 0.99


def test_a_prediction_never_reads_language_or_source(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    assert identified(docs) == identified(other)


# ---------------------------------------------------------------------------
# Hard negatives
# ---------------------------------------------------------------------------

def mined_by_brute_force(rows, scale=256):
    import math

    kept = [(i, lab, [math.floor(scale * float(x)) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    product = lambda x, y: max(-2**63 + 1, min(2**63 - 1, sum(p * q for p, q in zip(x, y))))
    out = []
    for i, lab, v in {(i, lab, tuple(v)) for i, lab, v in kept if i % 50 == 0}:
        scored = [(product(v, w), j, m) for j, m, w in kept]
        for p, j, _ in sorted((s for s in scored if s[2] == lab and s[1] != i), key=lambda s: (-s[0], s[1]))[:5]:
            inside = sorted((s for s in scored if s[2] != lab and 50 * p <= 100 * s[0] <= 95 * p), key=lambda s: (-s[0], s[1]))[:3]
            out += [(i, j, r + 1, n[1], p, n[0]) for r, n in enumerate(inside)]
    return sorted(out)


def mined(vectors):
    return sorted(tuple(r) for r in hard_negatives.mine(vectors, F.col("id") % 50 == 0).collect())


def vector_rows():
    rnd = np.random.default_rng(6)
    centre = rnd.normal(size=(4, 10))
    rows = [(i, int(i % 3 == 0) * 2 + int(i % 5 == 0), (centre[i % 4] + rnd.normal(size=10) * 0.3).round(2).tolist()) for i in range(400)]
    rows += [(500, 0, None), (550, None, [1.0] * 10), (600, 1, [float("nan")] + [1.0] * 9), (650, 1, [float("inf")] + [1.0] * 9), (700, 1, [None] + [1.0] * 9),
             (None, 1, [0.5] * 10), (750, 9, [0.5] * 10), (800, 1, []), (850, 1, [0.5] * 3), (851, 0, [0.25] * 17), (350, *rows[350][1:]), (301, *rows[301][1:]), (302, 7, [0.0] * 10)]
    return rows


SCHEMA = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize("rows_in_chunk,at_once,pairs", [(hard_negatives.CHUNK_ROWS, hard_negatives.BLOCKS_AT_ONCE, hard_negatives.PAIRS), (7, 1, 13)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, rows_in_chunk, at_once, pairs):
    for name, value in (("CHUNK_ROWS", rows_in_chunk), ("BLOCKS_AT_ONCE", at_once), ("PAIRS", pairs)):
        monkeypatch.setattr(hard_negatives, name, value)
    rows = vector_rows()
    got = mined(spark.createDataFrame(rows, SCHEMA).withColumn("block", F.lit("x")).withColumn("score", F.lit(1)).repartition(3))
    assert got == mined_by_brute_force(rows) and len(got) > 20


def test_hard_negatives_of_huge_components_are_exact(spark):
    rnd = random.Random(8)
    rows = [(i, i % 2, [rnd.choice([1e3, 1e7, 3e15, 4e4]) * rnd.random() for _ in range(6)]) for i in range(0, 200, 5)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == mined_by_brute_force(rows)


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark.createDataFrame([], SCHEMA)) == []
    assert mined(spark.createDataFrame([(50, 1, [1.0])], SCHEMA)) == []
    assert mined(spark.createDataFrame([(50, 1, [1.0]), (1, 1, [1.0]), (2, 0, [0.75]), (3, 0, [0.95]), (4, 0, [0.96])], SCHEMA)) == [
        (50, 1, 1, 3, 65536, 62208), (50, 1, 2, 2, 65536, 49152)]


def test_bounds_hold_at_every_level():
    rnd = np.random.default_rng(1)
    for dim in (1, 3, 16, 64, 70):
        q = rnd.integers(-300, 300, (40, dim)).astype(np.int16)
        made = hard_negatives.Vectors(40, dim, np.arange(40).tobytes(), np.zeros(40, np.int64).tobytes(), q.tobytes())
        exact = made.q @ made.q.T
        for length in hard_negatives.segment_lengths(dim):
            mean, dev = made.summaries(length)
            low, high = hard_negatives._bounds(mean @ mean.T, dev @ dev.T)
            assert (low <= exact).all() and (exact <= high).all()
