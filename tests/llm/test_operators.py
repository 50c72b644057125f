"""The training-data operators against brute force, and their edge cases."""

import hashlib
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

pytest.importorskip("riskgrid.llm")

import corpus_pipeline  # noqa: E402
from riskgrid.llm import (  # noqa: E402
    decontaminate, line_templates, mixing, near_dup, paragraph_dedup, pu_classifier, quality_rules, queries, secrets, suffix_dedup, token_counts)

SF001 = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, copies int, n_words string, node binary, spans int"


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def edge_rows():
    """Null id, null and empty text, white space only, a very long text, ties and repeated rows, clashing columns."""
    rnd = random.Random(5)
    long = "\n".join(words(rnd, 40) for _ in range(300))
    prose = "\n".join(words(rnd, 20) for _ in range(6))
    texts = [(1, prose), (1, prose), (2, prose), (None, prose), (3, None), (4, ""), (5, " \n\t "), (6, long), (7, long + " more"),
             (None, None), (8, "One"), (9, "a\n\n\nb"), (10, 'token = "Zx9abcdef123"\nAKIA' + "Q" * 20), (4, "")]
    return [(i, t, None if i == 2 else "en", None if i == 8 else f"s{(i or 0) % 2}", None, "x", 1, "y", b"z", 2) for i, t in texts]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven"), (2, "Short item"), (None, None), (3, "")],
                                 "item_id long, text string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (3, 0, 0), (None, 1, 0), (6, 1, None), (7, None, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet")


@pytest.fixture(scope="module")
def texts(sample):
    return {r.doc_id: r.text for r in sample.collect()}


OPERATORS = {
    "suffix": lambda d, b, lab: suffix_dedup.remove_repeats(d),
    "classifier": lambda d, b, lab: pu_classifier.classify(d, lab),
    "tokens": lambda d, b, lab: token_counts.prefix_counts(d, queries.vocabulary()),
    "secrets": lambda d, b, lab: secrets.find_secrets(d),
    "near": lambda d, b, lab: near_dup.near_duplicates(d, size=4),
    "decontaminate": lambda d, b, lab: decontaminate.report(d, b),
    "paragraphs": lambda d, b, lab: paragraph_dedup.report(d),
    "lines": lambda d, b, lab: line_templates.drop_recurring_lines(d),
    "rules": lambda d, b, lab: quality_rules.judge(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_its_result_and_empty_tables_are_empty(name, edges, nothing, bench, labels):
    assert OPERATORS[name](edges, bench, labels).count() == len(edge_rows())
    assert OPERATORS[name](nothing, bench.limit(0), labels.limit(0)).count() == 0


def test_suffix_array_finds_all_repeats_of_random_strings():
    rnd = random.Random(3)
    for _ in range(40):
        strings = list(dict.fromkeys(bytes(rnd.choice(b"ab") for _ in range(rnd.randint(5, 40))) for _ in range(rnd.randint(1, 5))))
        covered = covered_bytes(strings, 5)
        for s, runs, want in zip(strings, suffix_dedup.repeated_bytes(strings, [1] * len(strings), 5), covered):
            assert sum(b - a for a, b in runs) == want.sum()


def test_maximal_repeats_have_all_their_places():
    array = suffix_dedup.SuffixArray([b"xabcdey", b"zabcdew", b"qabcder"], [5, 5, 5])
    found = {(n, tuple(sorted(p.tolist()))) for n, p in array.maximal_repeats(3)}
    assert found == {(5, (1, 9, 17))}  # bcde and cde stand inside, always behind the same byte


def covered_bytes(texts, length):
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for j in range(len(t) - length + 1):
            places[t[j:j + length]].append((i, j))
    out = [np.zeros(len(t), bool) for t in texts]
    for p in places.values():
        if len(p) > 1:
            for i, j in p:
                out[i][j:j + length] = True
    return out


def test_suffix_dedup_moves_texts_compressed(spark):
    texts = ["", None, "ü" * 3 + "ab " * 400, "x y z " * 300]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r[0]: r for r in suffix_dedup.packed_texts(docs, "doc_id", "text").collect()}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        assert rows[i]["size"] == len(data) and (len(data) < 100 or len(rows[i]["packed"]) < len(data) / 5)
        assert suffix_dedup._unpacked(pa.array([rows[i]["packed"]]), pa.array([rows[i]["size"]])) == [data]
    key = docs.select(*suffix_dedup.key_columns("doc_id", "text"))
    wanted = key.where(f"{key.columns[0]} >= 2").selectExpr("*", f"{key.columns[0]} AS name", "7L AS digest", "2L AS copies", "0L AS bundle", "1 AS start", "5 AS windows")
    found = suffix_dedup._fetch(docs, wanted, "doc_id", "text", 60)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {r.name: bytes(r.bytes) for r in found.collect()} == {i: texts[i].encode()[1:65] for i in (2, 3)}


@pytest.mark.parametrize("bundle", [suffix_dedup.BUNDLE, 1500])
def test_suffix_dedup_equals_brute_force(sample, texts, bundle):
    ids = sorted(texts)
    data = [texts[i].encode() for i in ids]
    want = {i: (int(c.sum()), hashlib.sha256(np.frombuffer(t, np.uint8)[~c].tobytes()).hexdigest()) for i, t, c in zip(ids, data, covered_bytes(data, 200))}
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(sample, bundle=bundle).collect()}
    assert got == want


def test_prefix_counts_equal_the_library_at_every_prefix():
    count = token_counts.counter(queries.vocabulary())
    size = lambda t: len(count.library.encode(t, add_special_tokens=False).ids)
    rnd = random.Random(1)
    parts = [" ", "  ", "\n", "'", "'re", "'s", "'ll", "<|endoftext|>", "<|endof", "a", "The", " the", "1", "23", "!", "é", "日本", " ", "\t", "🙂",
             "\x1c", "\x85", "aaa", "    ", "=====", "²", "hello world", "İ"]
    for _ in range(400):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 10)))
        changes = token_counts.narrow(count.text(text)).tobytes()
        for i in range(len(text) + 1):
            assert token_counts.tokens_at(changes, i) == size(text[:i]), (text, i)
    changes = token_counts.narrow(count.text("hello world and all that")).tobytes()
    assert token_counts.longest_within(changes, 2) == len("hello world")


def test_token_counts_equal_the_library(sample, texts):
    library = token_counts.counter(queries.vocabulary()).library
    for r in queries.op3_token_counts(sample.sparkSession, SF001).collect():
        assert r.n_tokens == len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.over_limit) == (len(texts[r.doc_id].encode()), r.n_tokens > 512)


def test_answers_of_the_prefix_table_equal_encoding_again(sample, texts, edges):
    library = token_counts.counter(queries.vocabulary()).library
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    table = token_counts.prefix_counts(sample, queries.vocabulary())
    out = token_counts.answers(table, budgets=(0, 64), lengths=(0, 300, 10 ** 9)).collect()
    assert len(out) == len(texts)
    for r in out[::5]:
        t = texts[r.doc_id]
        assert (r.tokens_of_0, r.tokens_of_300, r.tokens_of_1000000000) == (0, size(t[:300]), size(t))
        assert r.chars_within_0 == 0 and r.chars_within_64 == max(k for k in range(min(len(t), 2000) + 1) if size(t[:k]) <= 64)
    got = token_counts.answers(token_counts.prefix_counts(edges, queries.vocabulary()), budgets=(3,)).where("n_bytes = 0").collect()
    assert len(got) == 4 and all((r.n_chars, r.n_tokens, r.chars_within_3) == (0, 0, 0) for r in got)


def test_changes_beyond_a_signed_byte_take_two_bytes():
    changes = np.array([1, 200, -300, 5], np.int16)
    wide = token_counts.narrow(changes)
    assert wide.itemsize == 2 and token_counts.narrow(changes[:1]).itemsize == 1
    assert [token_counts.tokens_at(wide.tobytes(), k, 2) for k in range(5)] == [0, 1, 201, -99, -94]
    assert token_counts.longest_within(wide.tobytes(), 0, 2) == 4


def test_token_caches_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(token_counts, "PIECE_BYTES", 20_000)
    monkeypatch.setattr(token_counts, "PAIR_BYTES", 20_000)
    count = token_counts.PrefixCounter(queries.vocabulary())
    rnd = random.Random(12)
    for _ in range(40):
        t = words(rnd, 200)
        assert int(count.text(t).sum(dtype=np.int64)) == len(count.library.encode(t, add_special_tokens=False).ids)
        assert len(count) <= 100 and len(count.known) <= 20_000 // token_counts.PAIR_ENTRY + 200


def test_token_beginnings_are_numbered_and_long_pieces_counted():
    count = token_counts.PrefixCounter(queries.vocabulary())
    whole = {t for t in count.tokens if t is not None}
    for token in (b"a", b" the", "é".encode(), max(whole, key=len)):
        at = 0
        for byte in token:
            at = count.after[256 * at + byte]
        assert count.tokens[at] == token
    assert len(whole) >= 50_000 and count.longest == max(map(len, whole))
    rnd = random.Random(13)
    for text in ("a" * 3000, "".join(rnd.choice("abcéß") for _ in range(3000)), "=" * 700, "日本語" * 200):
        assert int(count.text(text).sum(dtype=np.int64)) == len(count.library.encode(text, add_special_tokens=False).ids)
    assert all(isinstance(k, int) for k in count.known)


def components_by_brute_force(sets, percent):
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in ids}


def word_sets(texts, n):
    out = {}
    for i, t in texts.items():
        w = t.encode().lower().split()
        k = min(n, len(w))
        out[i] = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if w else set()
    return out


def test_near_duplicates_equal_brute_force(sample, texts):
    sets = word_sets(texts, 4)
    want = components_by_brute_force(sets, 80)
    got = queries.op5_minhash_near_dedup(sample.sparkSession, SF001).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), c, c == i) for i, c in want.items()}


def test_large_candidate_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    monkeypatch.setattr(near_dup, "LEADERS", 2)
    rnd = random.Random(9)
    base = words(rnd, 80).split()
    texts = {}
    for i in range(60):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 3, 5])):
            w[rnd.randrange(len(w))] = f"z{rnd.randrange(10**6)}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(df, size=4).collect()}
    assert got == components_by_brute_force(word_sets(texts, 4), 80)


def test_batch_signatures_equal_those_of_single_texts(texts):
    batch = [*list(texts.values())[:40], "", None, "one", "a b c", "x " * 3000]
    counts, keys, buckets = near_dup.describe(batch, 5, 10, 3)
    for t, n, key, held in zip(batch, counts, keys, buckets):
        s = near_dup.shingles(t or "", 5)
        assert n == len(s) and (key is None) == (n == 0)
        if n:
            assert key == hashlib.md5(s.tobytes()).digest()
            assert (held == near_dup._band_table(near_dup.signature(s, 30)[None], 10, 3)[0]).all()


def test_paragraph_dedup_removes_all_but_the_first(sample, texts):
    items = {(i, k): t[a:b] for i, t in texts.items() for k, (a, b) in enumerate(paragraph_dedup.paragraphs(t))}
    sets = {k: set(near_dup.shingles(v, 5).tolist()) for k, v in items.items()}
    want = components_by_brute_force(sets, 80)
    gone = defaultdict(int)
    for k, first in want.items():
        gone[k[0]] += k != first
    got = {r.doc_id: r.n_removed for r in paragraph_dedup.report(sample).collect()}
    assert got == {i: gone[i] for i in texts}


def test_removed_paragraphs_leave_the_rest(spark):
    rnd = random.Random(2)
    same, own = words(rnd, 60), [words(rnd, 30), words(rnd, 30)]
    df = spark.createDataFrame([(1, f"{own[0]}\n{same}"), (2, f"{same}\n{own[1]}")], "doc_id long, text string")
    left = {r.doc_id: r.text for r in paragraph_dedup.remove_repeated(df).collect()}
    assert left == {1: f"{own[0]}\n{same}", 2: f"\n{own[1]}"}


def removed_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: [tuple(map(int, s.split(":"))) for s in r.removed.split(",") if s] for r in paragraph_dedup.report(df).collect()}


def check_windows(texts, removed, n=51):
    """Of each run of n words that an earlier text or place holds, at least a window is removed; the first copy of each stays."""
    first, repeats = {}, 0
    for i, t in enumerate(texts):
        spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        for k in range(len(spans) - n + 1):
            at = (i, spans[k][0], spans[k + n - 1][1])
            if first.setdefault(tuple(t[a:b].lower() for a, b in spans[k:k + n]), at) != at:
                repeats += 1
                inside = sum(len(t[max(a, at[1]):min(b, at[2])].split()) for a, b in removed[i] if a < at[2] and b > at[1])
                assert inside >= paragraph_dedup.WINDOW, (i, at)
    assert all(b <= c for spans in removed.values() for (_, b), (c, _) in zip(spans, spans[1:]))
    return repeats


def test_passages_at_random_offsets_inside_long_lines_are_caught(spark):
    rnd = random.Random(6)

    def sentences(n, least, most):
        w = words(rnd, n).split()
        at = 0
        while (at := at + rnd.randint(least, most)) < n:
            w[at] += rnd.choice(['."', ".)", "!", "?", "."])
        return " ".join(w)

    texts, planted = [], []
    for n in (51, 55, 80, 200):
        for kind in (None, (4, 9), (18, 30)):
            for _ in range(6):
                p = sentences(n, *kind) if kind else words(rnd, n)
                planted.append(p)
                texts += [f"{words(rnd, rnd.randint(5, 90))} {p} {words(rnd, rnd.randint(5, 90))}" for _ in range(2)]
    removed = removed_spans(spark, texts)
    assert check_windows(texts, removed) >= 72
    assert all(not removed[i] for i in range(0, len(texts), 2))
    for i, p in enumerate(planted):
        t = texts[2 * i + 1]
        a = t.index(p)
        assert removed[2 * i + 1] and all(a <= s and e <= a + len(p) for s, e in removed[2 * i + 1])


def test_passages_on_short_lines_and_wrapped_at_other_widths_are_caught(spark):
    rnd = random.Random(7)

    def wrap(text, n):
        w = text.split()
        return "\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n))

    texts = []
    for n, first, second in ((51, 5, 5), (63, 3, 4), (148, 2, 7), (80, 7, 60), (200, 12, 9)):
        p = words(rnd, n)
        texts += [f"{words(rnd, 6)}\n{wrap(p, first)}\n{words(rnd, 4)}", f"{words(rnd, 9)} {wrap(p, second)}\n{words(rnd, 20)}"]
    removed = removed_spans(spark, texts)
    assert check_windows(texts, removed) >= 5
    assert not any(removed[i] for i in range(0, len(texts), 2)) and all(removed[i] for i in range(1, len(texts), 2))


def test_a_text_that_repeats_itself_keeps_its_first_window(spark):
    period = "a b c d e f g"
    text = " ".join([period] * 30)
    left = [r.text for r in paragraph_dedup.remove_repeated(spark.createDataFrame([(0, f"x {text} y")], "doc_id long, text string")).collect()][0]
    assert left.split()[:33] == f"x {text}".split()[:33] and len(left.split()) < 80


def test_near_passages_inside_long_lines_are_caught(spark):
    """Passages with a word changed, in lines that share nothing else: by brute force, a removed window has a near one in an earlier text."""
    rnd = random.Random(8)
    texts = []
    for k in range(30):
        p = words(rnd, 120).split()
        q = list(p)
        q[rnd.randrange(40, 80)] = "changed"
        texts += [f"{words(rnd, 70)} {' '.join(p)} {words(rnd, 70)}", f"{words(rnd, 80)} {' '.join(q)} {words(rnd, 60)}"]
    removed = removed_spans(spark, texts)
    for i in range(0, len(texts), 2):
        assert not removed[i]
        gone = [w for a, b in removed[i + 1] for w in texts[i + 1][a:b].split()]
        assert len(gone) >= 60
        assert set(gone) <= set(texts[i].split())


def test_windows_linked_only_by_near_sets_are_one_component(spark):
    """A window's first or last word differs: no two are equal, the exact check links those that share a bucket."""
    rnd = random.Random(9)
    texts = []
    for k in range(60):
        p = words(rnd, paragraph_dedup.WINDOW - 1)
        # On short lines, so that no paragraph holds the words.
        texts += ["\n".join(" ".join(w[i:i + 6]) for i in range(0, len(w), 6)) for w in (f"{p} one".split(), f"{p} two".split())]
    removed = removed_spans(spark, texts)
    assert not any(removed[i] for i in range(0, len(texts), 2))
    # A pair at similarity 27 / 29 shares a bucket with a chance of 0.87.
    caught = [i for i in range(1, len(texts), 2) if removed[i]]
    assert len(caught) >= 40 and all(removed[i] == [(0, len(texts[i - 1]) - 4)] for i in caught)


def test_texts_of_short_lines_are_found_whatever_their_length(spark):
    rnd = random.Random(10)
    texts = []
    for lines in (2, 5, 6, 7, 8, 9):
        t = "\n".join(words(rnd, 6) for _ in range(lines))
        texts += [t, t]
    removed = removed_spans(spark, texts)
    assert not any(removed[i] for i in range(0, len(texts), 2)) and all(removed[i] for i in range(1, len(texts), 2))


def test_unique_texts_lose_nothing_to_their_own_windows(spark):
    rnd = random.Random(11)
    texts = [words(rnd, 3000) for _ in range(20)] + ["\n".join(words(rnd, 34) for _ in range(60))]
    assert not any(removed_spans(spark, texts).values())


def test_units_of_one_scan_equal_those_of_single_texts(texts):
    """Buckets and shingles by the batch-wise scan equal signatures made text by text."""
    for t in list(texts.values())[:200]:
        found = paragraph_dedup._units(t, {})
        spans = paragraph_dedup.paragraphs(t)
        assert found["n_shingles"][0] == len(spans)
        for k, (a, b) in enumerate(spans, 1):
            assert (found["place"][k], found["start"][k], found["end"][k]) == (k - 1, a, b)
            assert (found["buckets"][k] == near_dup.describe([t[a:b]], 5, 7, 2)[2][0]).all()


def test_units_of_texts_cut_together_equal_those_of_single_texts(texts):
    some = [*list(texts.values())[:60], "", "a b", " \n ", "é " * 40 + "\n" + "ü. " * 80, "x " * 31, "Zß\ty\x0b" * 25, "ab " * 52]
    seen = {}
    together = paragraph_dedup._units([t.encode() for t in some], seen)
    for i, t in enumerate(some):
        alone, own = paragraph_dedup._units(t, {}), together["text"] == i
        assert own.sum() == len(alone["text"])
        assert all(np.array_equal(together[c][own], alone[c]) for c in alone if c not in ("text", "node"))
        assert [x for x, mine in zip(together["node"], own) if mine] == alone["node"]
    place = together["place"]
    arrays = dict(zip(paragraph_dedup._COLUMNS[2:], paragraph_dedup._unit_arrays(together)))
    assert all(arrays["buckets"].is_valid().to_numpy(False) == (place >= 0)) and all(arrays["bucket"].is_valid().to_numpy(False) == (place == paragraph_dedup.PIECE))
    assert (np.array(arrays["buckets"].drop_null().to_pylist()) == together["buckets"][place >= 0]).all()


def test_words_hashed_together_have_the_hashes_of_the_library():
    rnd = random.Random(3)
    some = [bytes(rnd.randrange(33, 256) for _ in range(rnd.randrange(1, 20))) for _ in range(3000)]
    got = paragraph_dedup._Words([b" ".join(some[:2000]), b"", b"\t\n".join(some[2000:])], {})
    assert got.hashes.tolist() == [xxhash.xxh3_64_intdigest(w.lower()) for w in some]
    assert got.first.tolist() == [0, 2000, 2000, 3000]


def test_windows_of_a_text_are_the_first_least_of_their_neighbours():
    rnd = random.Random(8)
    for n in (31, 32, 40, 50, 51, 52, 70, 200):
        shingle = np.array([rnd.randrange(9) for _ in range(3 + n - 4)], np.uint64)  # many ties; three words of a text before
        count = max(n - 31, 0)
        want = {i + int(shingle[3 + i:3 + i + min(count, 20)].argmin()) for i in range(count - min(count, 20) + 1)} if count else set()
        at, keys = paragraph_dedup._taken(shingle, np.array([0, 3, 3 + n]))
        assert (at - 3).tolist() == sorted(want) and len(keys) == len(at)


@pytest.mark.parametrize("pairs, together", [(1_000_000, 500_000), (40, 1), (0, 200)])
def test_links_of_many_blocks_equal_brute_force(spark, monkeypatch, pairs, together):
    """Blocks worked on together, by shared shingles or node by node, find the links of each block alone."""
    monkeypatch.setattr(near_dup, "PAIRS", pairs)
    monkeypatch.setattr(near_dup, "TOGETHER", together)
    rnd = random.Random(21)
    rows = []
    for block in range(12):
        base = words(rnd, 40).split()
        for k in range(rnd.choice([1, 2, 5, 20])):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 2, 9])):
                w[rnd.randrange(len(w))] = f"z{rnd.randrange(50)}"
            rows.append((block % 2, block, f"{block}-{k}".encode(), f"{block}-{k // 4 * 4 if block % 3 else k}".encode(), " ".join(w)))
    rows += [(0, 0, b"short", b"short", "one two"), (0, 0, b"again", b"again", "one two"), rows[0]]
    groups = {}
    for grp, block, node, label, text in rows:
        groups.setdefault((grp, block), {})[node] = label, text
    size = 5
    got = list(zip(*near_dup._group_links(list(groups.values()), size, 80)))
    df = spark.createDataFrame(rows, "grp int, block int, node binary, label binary, text string")
    by_spark = [(bytes(r.a), bytes(r.b)) for r in near_dup.block_links(df, ["grp", "block"], size, 80).collect()]
    for g in groups.values():
        sets = {x: set(near_dup.shingles(t, size).tolist()) for x, (_, t) in g.items()}
        want = components_by_brute_force(sets, 80)
        for edges in (got, by_spark):
            root = {x: x for x in g}

            def top(x):
                while root[x] != x:
                    x = root[x]
                return x
            first = {}
            same_label = [(x, first.setdefault(label, x)) for x, (label, _) in sorted(g.items())]
            linked = [(a, b) for a, b in edges if a in g]
            assert all(b in g and g[a][0] != g[b][0] for a, b in linked)
            for a, b in linked + same_label:
                root[max(top(a), top(b))] = min(top(a), top(b))
            both = {x: x for x in g}

            def high(x):
                while both[x] != x:
                    x = both[x]
                return x
            for a, b in [*want.items(), *same_label]:
                both[max(high(a), high(b))] = min(high(a), high(b))
            assert {x: top(x) for x in g} == {x: high(x) for x in g}


def test_tables_of_the_search_are_dropped_when_done(spark, monkeypatch):
    """What is left of a paragraph search is what its result reads."""
    written = {}
    for module in (near_dup, paragraph_dedup):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, name, real=real: written.setdefault(f"{name} {len(written)}", real(df, name)))
    rnd = random.Random(4)
    base = words(rnd, 60)
    texts = [base, base + " end", *(words(rnd, 50) for _ in range(4)), base.replace(base.split()[30], "other", 1)]
    found = paragraph_dedup.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    files = {name: df.inputFiles() for name, df in written.items()}
    left = {name.split()[0] for name, own in files.items() if own and all(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f).getFileSystem(
        spark.sparkContext._jsc.hadoopConfiguration()).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)) for f in own)}
    assert {"units", "windows", "unit-documents", "marks"} <= left
    assert not left & {"edges", "members", "wanted", "links", "colliding", "unit-sets", "unit-marks", "repeated-units", "near-windows"}, left
    assert sum(r.n_removed for r in found.collect()) > 0


def test_units_that_share_no_bucket_are_not_carried(spark, monkeypatch):
    """Only documents, and units that another place may hold too, are written as rows."""
    written = {}
    real = paragraph_dedup.materialize
    monkeypatch.setattr(paragraph_dedup, "materialize", lambda df, name: written.setdefault(name, real(df, name)))
    rnd = random.Random(21)
    texts = ["\n".join(words(rnd, 40) for _ in range(5)) for _ in range(30)]
    # One window's bucket held twice by one text, at places that overlap: a period of 7 words.
    texts.append(" ".join(["a1 b2 c3 d4 e5 f6 g7"] * 8))
    assert not any(removed_spans(spark, texts).values())
    assert written["units"].where("place >= 0").count() == written["windows"].count() == 0
    written.clear()
    assert removed_spans(spark, [*texts, "x " + texts[3].replace("\n", " ")])[30 + 1]
    held = Counter(r[0] for r in written["windows"].select("__key_id").collect())
    assert held[3] > 10 and held[31] > 10 and sum(held.values()) - held[3] - held[31] < 10
    assert written["units"].where("place = -1").count() == 32


def test_keys_held_twice_pass_the_filter(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    units = paragraph_dedup._units([b"\n".join(b"%d" % x for x in rnd.integers(0, 9, 400))] + [b"a b c d e f g h i " * 9], {})
    own = units["place"] == paragraph_dedup.PIECE
    windows = pa.RecordBatch.from_arrays([pa.array(units[c][own]) for c in ("start", "end", "bucket", "words", "text")], names=["start", "end", "bucket", "words", "text"])
    want = Counter()
    for text, key in set(zip(units["text"][own].tolist(), units["bucket"][own].tolist())):
        at = own & (units["text"] == text) & (units["bucket"] == key)
        want[key] += 1 + bool(units["start"][at].max() >= units["end"][at].min())
    once, apart = paragraph_dedup._held(windows)
    assert Counter([*once.tolist(), *apart.tolist()]) == want and max(want.values()) > 1
    monkeypatch.setattr(paragraph_dedup, "NAMES", 500)
    texts = [f"{words(random.Random(i % 40), 60)}" for i in range(60)]
    parts = paragraph_dedup.unit_parts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "doc_id", "text")
    bits, width = paragraph_dedup.key_filter(paragraph_dedup.repeated_keys(parts))
    bits = np.frombuffer(bits, np.uint8)
    every = [paragraph_dedup._units(t, {}) for t in texts]
    held = [np.unique(np.append(u["buckets"][u["place"] >= 0].ravel(), u["bucket"][u["place"] == paragraph_dedup.PIECE])) for u in every]
    keys = np.concatenate(held)
    times = Counter(keys.tolist())
    passes = paragraph_dedup._may_repeat(keys, bits, width)
    twice = np.array([times[k] > 1 for k in keys.tolist()])
    assert passes[twice].all() and twice.sum() > 200 and (passes & ~twice).sum() <= 0.02 * len(keys)


def test_shuffle_files_of_a_paragraph_search_go_when_a_table_is_written(spark):
    def files() -> set[str]:
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}

    rnd = random.Random(8)
    base = words(rnd, 60)
    docs = spark.createDataFrame(list(enumerate([base, base + " end", *(words(rnd, 50) for _ in range(4))])), "doc_id long, text string")
    key = next(iter(paragraph_dedup.CLEANED))
    before, own = files(), spark.conf.get(key)
    paragraph_dedup.repeated_paragraphs(docs)
    for _ in range(40):
        if not (left := files() - before):
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(key) == own


def test_blocks_of_unlinked_sets_with_common_shingles(monkeypatch):
    """Sets that share many common shingles and aren't linked are not compared node by node."""
    rnd = random.Random(3)
    common = words(rnd, 12).split()

    def window():
        w = words(rnd, 20).split()
        k = rnd.randrange(20)
        return " ".join(w[:k] + common + w[k:])

    texts = {i.to_bytes(4, "big"): window() for i in range(1500)}
    groups = [{x: (x, t) for x, t in texts.items()}]
    groups[0][b"copy"] = (b"copy", texts[(7).to_bytes(4, "big")].upper())
    monkeypatch.setattr(near_dup, "linked", lambda *_: pytest.fail("node by node"))
    a, b = near_dup._group_links(groups, 5, 80)
    assert {*a, *b} == {b"copy", (7).to_bytes(4, "big")}


def test_components_write_each_node_once(spark, monkeypatch):
    """A round writes its own nodes only; all nodes are written again once, at the end."""
    written = []
    real = near_dup.materialize
    monkeypatch.setattr(near_dup, "materialize", lambda df, name: written.append((name, (out := real(df, name)).count())) or out)
    n = 300
    chain = [(f"{i * 7919 % n:03}".encode(), f"{(i + 1) * 7919 % n:03}".encode()) for i in range(n - 1)]
    got = {bytes(r.node): bytes(r.root) for r in near_dup.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert got == {f"{i:03}".encode(): b"000" for i in range(n)}
    assert sum(count for name, count in written if name != "edges") < 3 * n, written


def test_edge_rows_of_paragraph_dedup(edges):
    got = defaultdict(list)
    for r in paragraph_dedup.report(edges).collect():
        got[r.doc_id].append((r.n_paragraphs, r.n_repeated, r.n_removed, len(r.removed), r.first_docs))
    prose = got[None]
    assert sorted(prose)[0] == (0, 0, 0, 0, []) and sorted(prose)[1][:3] == (6, 6, 0)
    assert [x[:3] for x in got[1]] == [(6, 6, 6)] * 2 and got[2][0][:3] == (6, 6, 6) and got[1][0][4] == []
    for i in (3, 4, 5, 8, 9):
        assert all(x == (0, 0, 0, 0, []) for x in got[i])
    assert len(got[4]) == 2 and got[6][0][:3] == (300, 300, 0) and got[7][0][:3] == (300, 300, 300)


def test_secrets_of_one_owner_are_added_and_copied_ones_are_not(spark):
    live, copied = "aB3dE5gH7jK9mN1pQ2rS4tU6", "zY8xW6vU4tS2rQ0pO9nM7lK5"
    rows = [(1, f"use {live} here", "en", "a"), *[(i, f"use {copied} here", "en", f"o{i}") for i in range(2, 6)],
            (6, "password: short token=secret:longvalue123 API_KEY = 'abcdefgh1'", "en", "a")]
    got = {r.doc_id: r for r in secrets.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[1].spans == f"token:4:{4 + len(live)}" and got[1].n_live == 1
    assert got[2].spans == "" and got[2].n_copied == 1
    text = rows[-1][1]
    at = text.index("API_KEY")
    assert got[6].spans == f"assign:{at}:{len(text) - 1}" and got[6].n_assign == 1
    assert got[6].base_sha256 == hashlib.sha256(got[6].spans.encode()).hexdigest()


def test_base_measures_by_hand():
    line = "a b c d e f"
    got = dict(zip(quality_rules.MEASURES, quality_rules.measure(f"{line}\n{line}\n#|x")))
    assert (got["n_words"], got["word_chars"], got["n_symbols"], got["n_dup_lines"]) == (13, 15, 2, 1)
    assert got["n_repeat_words"] == 12  # abcde and bcdef twice each


def test_rules_and_classifier_separate_labelled_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scores = [(r.score, truth[r.doc_id], r.predicted) for r in queries.op2_quality_classifier(spark, sf).where("held_out").collect() if r.doc_id in truth]
    good, bad = [s for s, q, _ in scores if q], [s for s, q, _ in scores if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([p == q for _, q, p in scores]) > 0.9
    rules = [(r.kept, truth[r.doc_id], r.base_failed) for r in queries.op10_quality_rules(spark, sf).collect() if r.doc_id in truth]
    assert np.mean([k for k, q, failed in rules if q and not failed]) > 0.95
    assert np.mean([not k for k, q, _ in rules if not q]) > 0.9


def test_the_negative_risk_stays_above_zero(spark):
    rows = spark.createDataFrame([([float(i % 7)] * pu_classifier.N_FEATURES, i % 2 == 0) for i in range(200)], "x array<float>, p boolean")
    model = pu_classifier.fit(rows, 0.9)
    z = model.design(np.array([[float(i % 7)] * pu_classifier.N_FEATURES for i in range(200)])) @ model.weights
    p = np.arange(200) % 2 == 0
    assert np.logaddexp(0, z).mean() - 0.9 * np.logaddexp(0, z[p]).mean() >= -1e-9


def test_short_items_and_spans(spark, bench):
    text = "See: SHORT, item! One two three four five six seven eight nine ten ELEVEN. End"
    df = spark.createDataFrame([(1, text), (2, "short and item"), (3, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items) for r in decontaminate.report(df, bench).collect()}
    assert got == {1: (13, 2), 2: (0, 0), 3: (0, 0)}
    assert {r.doc_id: r.text for r in decontaminate.decontaminate(df, bench, remove="spans").collect()}[1] == "See: End"
    assert sorted(r.doc_id for r in decontaminate.decontaminate(df, bench).collect()) == [2, 3]


def test_lines_with_variable_fields_are_one_template_and_copies_do_not_vote(spark):
    rnd = random.Random(4)
    copy = "\n".join(words(rnd, 12) for _ in range(5))
    rows = [(i, f"{words(rnd, 15)}\nPage {i} of the site was seen by user{i} today\n{words(rnd, 11)}") for i in range(12)]
    rows += [(100 + i, copy) for i in range(20)]
    out = {r.row.doc_id: r for r in line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(out[i].n_dropped == 1 and "Page" not in out[i].text_kept for i in range(12))
    assert all(out[100 + i].text_kept == copy for i in range(20))


def test_mix_follows_the_weights_and_keeps_nulls(spark, edges):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 == 0, "a").otherwise("b").alias("source"))
    n = {r.source: r["count"] for r in mixing.mix(df, weights={"a": 0.5, "b": 0.5}).groupBy("source").count().collect()}
    assert abs(n["a"] - 10_000) < 500 and abs(n["b"] - 10_000) < 500
    assert mixing.mix(edges).columns[-2:] == ["copy", "shuffle_key"]
    first = sorted(mixing.mix(edges).select("doc_id", "copy", "shuffle_key").collect(), key=str)
    assert first == sorted(mixing.mix(edges.repartition(7)).select("doc_id", "copy", "shuffle_key").collect(), key=str)


def test_pipeline_stages_by_brute_force(spark, edges, nothing, tmp_path):
    """Each stage on its own input: clean documents stay, planted ones go, columns are kept."""
    sf = SF001
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        before = {r.doc_id: r for r in docs.collect()}
        after = out.collect()
        if k < 4:
            assert out.columns == docs.columns
            assert len({r.doc_id for r in after}) == len(after)
        if name == "quality_classifier":
            scored = {r.doc_id: r.predicted for r in pu_classifier.classify(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()}
            assert {r.doc_id for r in after} == {i for i, p in scored.items() if p}
        elif name == "line_dedup":
            assert {r.doc_id for r in after} == set(before) and all(r.n_chars == len(r.text) for r in after)
        elif name == "minhash_near_dedup":
            sets = word_sets({i: r.text for i, r in before.items()}, 5)
            assert {r.doc_id for r in after} == {i for i, c in components_by_brute_force(sets, 80).items() if i == c}
        elif name == "benchmark_decontamination":
            hit = {r.doc_id for r in decontaminate.report(docs, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r.contaminated}
            assert hit and {r.doc_id for r in after} == set(before) - hit
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf).count() == 0
        stage(spark, edges, sf).collect()


def test_near_duplicate_stage_keeps_one_row_of_each_group_with_null_and_repeated_ids(spark, edges):
    rnd = random.Random(8)
    own = [words(rnd, 40) for _ in range(8)]
    near = [own[2] + " end", own[3] + " end"]
    rows = [(None, own[0]), (None, own[1]), (None, own[1]), (None, own[2]), (None, near[0]), (5, own[3]), (5, near[1]), (5, own[4]),
            (6, own[5]), (None, own[5]), (7, own[5]), (None, None), (None, ""), (8, own[6])]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), SF001).collect()
    got = sorted(r.text or "" for r in out)
    assert own[0] in got and got.count(own[1]) == 1
    assert got.count(own[2]) + got.count(near[0]) == 1 and got.count(own[3]) + got.count(near[1]) == 1
    assert [r.doc_id for r in out if r.text == own[5]] == [6] and own[4] in got and own[6] in got
    left = corpus_pipeline.near_duplicates(spark, edges, SF001).collect()
    prose = edge_rows()[0][1]
    assert [r.doc_id for r in left if r.text == prose] == [1]
    assert sum(len((r.text or "").split()) > 1000 for r in left) == 1


def test_mix_draws_large_rates_in_parts(spark):
    rare, common = 2, 4000
    rows = [(i, f"t{i}", "en", "rare" if i < rare else "common", 2) for i in range(rare + common)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    rates = {r["__group"]: r for r in mixing.group_rates(df).collect()}
    assert rates["rare"]["__parts"] == 16 and max(len(r["__cdf"]) for r in rates.values()) < 300
    out = mixing.mix(df)
    got = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert abs(got["rare"] - 2001) < 5 * 2001 ** 0.5 and abs(got["common"] - 2001) < 5 * 2001 ** 0.5
    per = out.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("copy").alias("d"), F.max("copy").alias("top")).collect()
    assert all(r["n"] == r["d"] == r["top"] for r in per)
    import duckdb
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    own = con.execute(mixing.sql()).fetchall()
    assert sorted(own) == sorted(tuple(r) for r in out.collect())


def test_candidates_keep_clear_of_base_spans():
    rnd = random.Random(3)
    for _ in range(300):
        text = "".join(rnd.choice(["password=", "Zx9abcdef123QwErTy77uIoPlK", " ", "AKIA" + "Q" * 20, "0123456789abcdef" * 2, "/", "\n"]) for _ in range(12))
        base = secrets.base_spans(text)
        got = [(s, e) for s, _, e, _ in secrets.candidates(text, base)]
        assert not any(s < e2 and s2 < e for s, e in got for s2, _, e2, _ in base)
        free = [(m.start(), m.end()) for m in secrets.TOKEN.finditer(text) if not any(s < m.end() and m.start() < e for s, _, e, _ in base)]
        assert set(got) <= set(free) and all((a, b) in got for a, b, v in ((a, b, text[a:b]) for a, b in free)
                                            if any(map(str.isdigit, v)) and any(map(str.islower, v)) and any(map(str.isupper, v)) and secrets.entropy(v) >= secrets.MIN_ENTROPY)


def test_mix_of_many_groups_joined_in_salted_parts_is_the_same(edges, sample, monkeypatch):
    for docs in (edges, sample):
        got = []
        for groups in (mixing.BROADCAST_GROUPS, 0):
            monkeypatch.setattr(mixing, "BROADCAST_GROUPS", groups)
            got.append(sorted(map(str, mixing.mix(docs).select("doc_id", "copy", "shuffle_key").collect())))
        assert got[0] == got[1] and got[0]


def lines_kept(spark, rows):
    out = line_templates.drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return {r.row.doc_id: r for r in out}


def test_pages_that_are_mostly_boilerplate_lose_it(spark):
    rnd = random.Random(12)
    menu = ["Home About Contact", "Terms", words(rnd, 9)]
    out = lines_kept(spark, [(i, "\n".join([*menu[:2], words(rnd, 12), menu[2]])) for i in range(200)])
    assert all(out[i].n_dropped == 3 and len(out[i].text_kept.split("\n")) == 1 for i in range(200))


def test_short_templates_need_equal_content(spark):
    rnd = random.Random(13)
    rows = [(i, f"{words(rnd, 9)}\nThe weather will be fine {words(rnd, 1)}{i % 7 * 'x'}\n{words(rnd, 8)}") for i in range(30)]
    rows += [(100 + i, f"{words(rnd, 9)}\nSubscribe to our free weekly newsletter\n{words(rnd, 8)}") for i in range(30)]
    rows += [(200 + i, f"{words(rnd, 9)}\nShare this page on {words(rnd, 1)}{i} now\n{words(rnd, 8)}") for i in range(30)]
    out = lines_kept(spark, rows)
    assert all(out[i].n_dropped == 0 for i in range(30))
    assert all(out[100 + i].n_dropped == 1 and "Subscribe" not in out[100 + i].text_kept for i in range(30))
    assert all(out[200 + i].n_dropped == 1 for i in range(30))


def test_edited_copies_keep_their_lines(spark):
    rnd = random.Random(14)
    own = [words(rnd, 12) for _ in range(20)]
    rows = []
    for i in range(300):
        text = list(own)
        for k in rnd.sample(range(20), 2):
            text[k] = words(rnd, 1) + " " + text[k]
        rows.append((i, "\n".join(text)))
    assert all(r.n_dropped == 0 for r in lines_kept(spark, rows).values())


def test_long_texts_with_many_dropped_lines(spark):
    rnd = random.Random(15)
    head = words(rnd, 6)
    rows = [(i, "\n".join(x for k in range(3000 if i == 0 else 3) for x in (head, "", words(rnd, 5)))) for i in range(12)]
    out = lines_kept(spark, rows)
    for i, text in rows:
        assert out[i].text_kept == "\n".join(x for x in text.split("\n") if x != head)
