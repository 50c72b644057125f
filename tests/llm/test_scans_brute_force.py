"""Secret spans and quality measures of whole tables against plain scans, character by character."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

pytest.importorskip("riskgrid.llm")

from riskgrid.llm import quality_rules, secrets  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string"
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
EMPTY = hashlib.sha256(b"").hexdigest()


def run_of(text, at, allowed):
    """The end of the longest run of allowed characters from ``at``."""
    while at < len(text) and text[at] in allowed:
        at += 1
    return at


def low(text):
    return "".join(c.lower() if c in UPPER else c for c in text)


def assign_at(text, at):
    """The end of an assignment that starts at ``at``, and where its value starts; None without one."""
    names = ["password", "passwd", "secret", "token", "api_key", "apikey"]
    for name in names:
        if low(text[at:at + len(name)]) == name:
            k = at + len(name)
            if text[k:k + 1] in ('"', "'"):
                k += 1
            k = run_of(text, k, " ")
            if text[k:k + 1] not in (":", "="):
                continue
            # What follows the sign may be spaces and a quote; "=" is a character of values too.
            k = run_of(text, k + 1, " ")
            if text[k:k + 1] in ('"', "'"):
                k += 1
            end = run_of(text, k, LOWER + UPPER + DIGITS + "+/_.=-")
            if end > k:
                return end, k
    return None


def base_by_scan(text):
    out = []
    at = 0
    while at < len(text):
        found = assign_at(text, at)
        if found:
            if found[0] - found[1] >= 8:
                out.append((at, 0, found[0], text[found[1]:found[0]]))
            at = found[0]
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run_of(text, at + 4, UPPER + DIGITS) if text[at:at + 4] == "AKIA" else at
        if end > at + 4:
            if end - at >= 16:
                out.append((at, 1, end, text[at:end]))
            at = end
        else:
            at += 1
    at = 0
    while at < len(text):
        end = run_of(text, at, DIGITS + "abcdef")
        if end - at >= 32:
            out.append((at, 2, end, text[at:end]))
        at = max(end, at + 1)
    return sorted(out)


def tokens_by_scan(text, base):
    out, at = [], 0
    while at < len(text):
        end = run_of(text, at, LOWER + UPPER + DIGITS + "+/_=-")
        v = text[at:end]
        bits = -sum(c / len(v) * math.log2(c / len(v)) for c in Counter(v).values()) if v else 0
        if (len(v) >= 20 and set(v) & set(DIGITS) and set(v) & set(LOWER) and set(v) & set(UPPER) and bits >= 3.5
                and all(e <= at or s >= end for s, _, e, _ in base)):
            out.append((at, 3, end, v, bits))
        at = max(end, at + 1)
    return out


def joined(spans):
    return ",".join(f"{('assign', 'access', 'hex', 'token')[k]}:{s}:{e}" for s, k, e in sorted(spans))


def secrets_by_scan(rows):
    holders, found = defaultdict(set), []
    for _, text, lang, source in rows:
        base = base_by_scan(text or "")
        tokens = tokens_by_scan(text or "", base)
        found.append((base, tokens))
        for v in [b[3] for b in base] + [t[3] for t in tokens]:
            holders[v].add((source, lang))
    examples = ("example", "sample", "dummy", "changeme", "placeholder", "your", "xxxx", "1234567", "abcdef", "test")
    out = []
    for (i, *_), (base, tokens) in zip(rows, found):
        live = [t for t in tokens if not any(e in t[3].lower() for e in examples)
                and len({s for s, _ in holders[t[3]]}) <= 1 and len(holders[t[3]]) <= 3]
        kinds = Counter(k for _, k, *_ in base)
        base_text = joined([b[:3] for b in base])
        out.append((str(i), kinds[0], kinds[1], kinds[2], hashlib.sha256(base_text.encode()).hexdigest(),
                    joined([b[:3] for b in base] + [t[:3] for t in live])))
    return sorted(out)


def made_rows():
    """Pieces of patterns in random order, so that matches touch, overlap, fall short and repeat among owners."""
    rnd = random.Random(11)
    hidden = ["".join(rnd.choice(LOWER + UPPER + DIGITS) for _ in range(24)) for _ in range(12)]
    pieces = ["password", "PassWd", "secret", "ToKeN", "api_key", "APIKEY", "api__key", '"', "'", " ", "  ", ":", "=", "==", "abcdefg", "abcdefgh",
              "AKIA", "AKIAAKIA", "A" * 12, "Z9" * 7, "0123456789abcdef" * 2, "deadbeef", "f" * 31, "\n", "\t", "é", "\U0001f600", "ſ", "K", ".", "-", "x", *hidden]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 40))), rnd.choice(["en", "fr", None]), rnd.choice(["a", "b", None])) for i in range(400)]
    rows += [(1, rows[1][1], "en", "a"), (None, "token: " + "Ab1" * 9, "en", "a"), (500, None, "en", "a"), (501, "", None, None), (502, " ".join(r[1] for r in rows) * 4, "en", "a")]
    return rows


def got_secrets(docs):
    return sorted((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secrets.find_secrets(docs).collect())


def test_secrets_of_made_texts_equal_a_plain_scan(spark):
    rows = made_rows()
    want = secrets_by_scan(rows)
    assert sum(w[1] for w in want) > 50 and sum(w[2] for w in want) > 50 and sum(w[3] for w in want) > 50 and any("token" in w[5] for w in want)
    assert got_secrets(spark.createDataFrame(rows, SCHEMA)) == want


def test_secrets_of_documents_equal_a_plain_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    assert got_secrets(docs) == secrets_by_scan([tuple(r) for r in docs.collect()])


def test_secrets_of_edge_rows(spark):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (None, "AKIA" + "Q" * 12, None, None), (3, "AKIA" + "Q" * 11, "en", "a")]
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256, r.spans) for r in secrets.find_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got[1] == got[2] == got[3] == (0, 0, 0, EMPTY, "")
    assert got[None] == (0, 1, 0, hashlib.sha256(b"access:0:16").hexdigest(), "access:0:16")


def measured_by_scan(text):
    spaces, words, lines, word = " \t\n\x0b\x0c\r", [], [], ""
    for c in (text or "") + " ":
        if c in spaces:
            words += [word] if word else []
            word = ""
        else:
            word += c
    for line in (text or "").split("\n"):
        if any(c not in spaces for c in line):
            lines.append(line)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    repeated = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated))


def judged_by_scan(rows):
    out = []
    for i, text in rows:
        m = measured_by_scan(text)
        out.append((str(i), *m, m[0] < 10 or 100 * m[4] > 20 * m[0]))
    return sorted(out)


def got_measures(docs):
    rows = quality_rules.judge(docs).collect()
    assert all(not r.kept for r in rows if r.base_failed)
    assert all(r.kept == (r.p_good >= 0.5) for r in rows if not r.base_failed)
    return sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)


def test_base_measures_of_made_texts_equal_a_plain_scan(spark):
    rnd = random.Random(4)
    pieces = ["a", "b", "c", "dd", "é", "\U0001f600", "#", "|", "<>", " ", " ", " ", "\n", "\n", "\t", "\x0b", "\r", "\x0c", "\xa0", "\x85", " ", "a b c dd e\n"]
    rows = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 160)))) for i in range(300)]
    rows += [(1, rows[1][1]), (None, rows[2][1]), (400, None), (401, ""), (402, " \n\t"), (403, " ".join(r[1] for r in rows[:60]))]
    assert got_measures(spark.createDataFrame(rows, "doc_id long, text string")) == judged_by_scan(rows)


def test_base_measures_of_documents_equal_a_plain_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert got_measures(docs) == judged_by_scan([tuple(r) for r in docs.collect()])
