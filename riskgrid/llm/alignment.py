"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

A is a byte-level vocabulary (``.json``), read over a blank and the text; B a sentencepiece vocabulary (``.model``) that
adds this blank itself. Both cut the same bytes. An interval of A's tokens is split at a byte where a token of A and
a token of B both end: the middle of A's ends is looked up among B's by bisection, then its neighbours outward, and both
halves are split in turn; an interval without a shared end inside is a group. All intervals of a batch are worked on at once,
level by level. Those whose first ``TRIES`` ends around the middle are not shared have all their ends looked up
in one step, so that long stretches without a shared end cost no long walk.

Within its group, a token of A and one of B are linked if their bytes overlap. A pair of ids counts as many links as hold
it in the whole corpus; a link is best if no other A id has more links with its B id (ties included).

Texts are encoded once: tokens are written beside the tasks' counts of pairs, and the second pass reads them
again. Before a blank that follows a non-blank, both vocabularies always cut, so equal words are encoded once per
worker (in tables bounded by bytes); of vocabularies for which that does not hold, whole texts are encoded.

Null and empty texts, and those whose tokens do not join to the blank and the text (normalised or unknown characters),
have no tokens: zeros and an empty ``groups_sha256``. Special strings are plain text. Very long texts stay whole. Rows are
treated one by one, so repeated rows, ties and null ids pass through, and every copy's links count. Extra columns are
ignored; an empty table gives an empty result.

Counts of pairs go to the tasks as a broadcast of at most ``PAIRS_SENT`` pairs, after a count; pairs linked only once need not
be sent. More are joined to the texts' pairs by shuffle, with equal results.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgrid.llm.common import arrow_map, empty_text
from riskgrid.llm.token_counts import byte_alphabet
from riskgrid.session import checkpoint_dir

#: Ends around the middle of an interval that are looked up one by one.
TRIES = 9
#: Bytes of known words that a worker keeps, roughly; then the tables start anew.
WORD_BYTES = 96 << 20
#: Words encoded at once, and the longest of them; longer ones are encoded alone.
TOGETHER, LONGEST = 500, 1000
#: A blank (or several) and what follows, up to the next blank behind a non-blank.
WORD = re.compile(r" +[^ ]*(?:(?<=\s) +[^ ]*)*")
#: Pairs that a task counts before it hands its counts on.
PAIRS_KEPT = 1_000_000
#: Pairs that are broadcast at most (16 bytes each).
PAIRS_SENT = 4_000_000
BLANK = "▁"


# ---------------------------------------------------------------------------
# Divide and conquer
# ---------------------------------------------------------------------------

def _shared(ends_a: np.ndarray, ends_b: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether these ends of A are ends of B too, by bisection. The last ends of both are equal."""
    e = ends_a[at]
    return ends_b[np.searchsorted(ends_b, e)] == e


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each token of A, whether it ends a group. ``first`` holds where each text's tokens of A begin, and their number."""
    cut = np.zeros(len(ends_a), bool)
    lo, hi = first[:-1], first[1:]
    some = hi > lo
    lo, hi = lo[some], hi[some]
    cut[hi - 1] = True
    while len(lo):
        wide = hi - lo > 1
        lo, hi = lo[wide], hi[wide]
        mid = (lo + hi - 2) // 2
        found = np.full(len(lo), -1)
        left = np.arange(len(lo))
        for t in range(TRIES):
            at = mid[left] + (t + 1) // 2 * (-1 if t % 2 else 1)
            inside = (at >= lo[left]) & (at <= hi[left] - 2)
            hit = np.zeros(len(left), bool)
            hit[inside] = _shared(ends_a, ends_b, at[inside])
            found[left[hit]] = at[hit]
            left = left[~hit]
            if not len(left):
                break
        left = left[hi[left] - lo[left] - 1 > TRIES]
        if len(left):
            n = hi[left] - lo[left] - 1
            own = np.repeat(np.arange(len(left)), n)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + lo[left][own]
            hit = _shared(ends_a, ends_b, at)
            own, at = own[hit], at[hit]
            near = np.lexsort((at, np.abs(at - mid[left][own]), own))
            own, at = own[near], at[near]
            head = np.flatnonzero(np.diff(own, prepend=-1))
            found[left[own[head]]] = at[head]
        split = found >= 0
        found = found[split]
        cut[found] = True
        lo, hi = np.stack([lo[split], found + 1], 1).ravel(), np.stack([found + 1, hi[split]], 1).ravel()
    return cut


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums by text."""
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[first])


class Tokens:
    """The tokens of some texts and their links."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, len_a: np.ndarray, len_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        self.first_a, self.first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
        self.ends_a, self.ends_b = np.cumsum(len_a[a]), np.cumsum(len_b[b])

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, A id, B id) of every link: one for each end of a token of A, one for each other end of a token of B."""
        over = np.searchsorted(self.ends_a, self.ends_b)
        own = np.flatnonzero(self.ends_a[over] != self.ends_b)
        i = np.concatenate([np.arange(len(self.a)), over[own]])
        j = np.concatenate([np.searchsorted(self.ends_b, self.ends_a), own])
        text = np.concatenate([np.repeat(np.arange(len(self.n_a)), self.n_a), np.searchsorted(self.first_b, own, "right") - 1])
        return text, self.a[i], self.b[j]


class Aligned(Tokens):
    """Tokens with their groups."""

    def __init__(self, *tokens: np.ndarray):
        super().__init__(*tokens)
        self.cut_a = shared_cuts(self.ends_a, self.ends_b, self.first_a)
        self.cut_b = np.zeros(len(self.b), bool)
        self.cut_b[np.searchsorted(self.ends_b, self.ends_a[self.cut_a])] = True
        self.n_groups = per_text(self.cut_a, self.first_a)
        self.n_links = self.n_a + self.n_b - self.n_groups  # one for each end of either

    def group_texts(self, words: np.ndarray, size_a: int) -> Iterator[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text. ``words`` holds every id's decimals with what follows it."""
        group_a, group_b = (np.cumsum(c) - c for c in (self.cut_a, self.cut_b))
        behind_a, behind_b = np.flatnonzero(self.cut_a) + 1, np.concatenate([[0], np.flatnonzero(self.cut_b) + 1])
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + behind_b[group_a]] = 2 * self.a + self.cut_a
        code[np.arange(len(self.b)) + behind_a[group_b]] = 2 * (size_a + self.b) + self.cut_b
        first = self.first_a + self.first_b
        for s, e in zip(first[:-1], first[1:]):
            yield "".join(words[code[s:e]].tolist())[:-1]


# ---------------------------------------------------------------------------
# The two vocabularies
# ---------------------------------------------------------------------------

class Words(dict):
    """word -> its number; new words get the next one and are listed."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class Pool:
    """Token ids of the numbered words, end to end."""

    def __init__(self):
        self.ids, self.first = np.zeros(1 << 16, np.int32), np.zeros(1 << 14, np.int64)

    def add(self, word: int, ids: np.ndarray, n: np.ndarray) -> None:
        """The ids of the words from number ``word`` on, ``n`` of each."""
        at = int(self.first[word])
        for name, need in (("ids", at + len(ids)), ("first", word + len(n) + 1)):
            old = getattr(self, name)
            if need > len(old):
                new = np.zeros(max(need, 2 * len(old)), old.dtype)
                new[:len(old)] = old
                setattr(self, name, new)
        self.ids[at:at + len(ids)] = ids
        self.first[word + 1:word + len(n) + 1] = at + np.cumsum(n)

    def take(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words, end to end, and the number of each."""
        first = self.first[words]
        n = self.first[words + 1] - first
        return self.ids[np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())].astype(np.int64), n


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the words met so far."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path_a)
        self.tok.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        alphabet = byte_alphabet()
        size = max(self.tok.get_vocab().values()) + 1
        self.bytes_a = [b""] * size
        for token, i in self.tok.get_vocab().items():
            self.bytes_a[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.len_a, self.len_b = (np.array([len(b) for b in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        decimals = [f"{i}{end}" for i in range(size) for end in ",|"] + [f"{i}{end}" for i in range(len(pieces)) for end in ",;"]
        self.words = np.array(decimals, object)
        spec = json.loads(self.tok.pre_tokenizer.__getstate__()) if self.tok.pre_tokenizer else {}
        self.by_word = (spec.get("type") == "ByteLevel" and spec.get("use_regex") is True and not spec.get("add_prefix_space") and self.tok.normalizer is None
                        and not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces))
        self.forget()

    def forget(self) -> None:
        self.known, self.pool_a, self.pool_b, self.odd, self.held = Words(), Pool(), Pool(), np.zeros(0, bool), 0

    def cut(self, text: str) -> list[str]:
        """The blank and the text, cut before every blank behind a non-blank."""
        return WORD.findall(f" {text}") if self.by_word else [f" {text}"]

    def one(self, word: str) -> tuple[list, list]:
        """The ids of one word. B reads it behind an ``a``, whose tokens are dropped, as it adds a blank of its own; whole texts begin with that blank."""
        a = self.tok.encode(word, add_special_tokens=False).ids
        if not self.by_word:
            return a, self.sp.encode(word[1:])
        return a, self.sp.encode(f"a{word}")[len(self.sp.encode("a")):]

    def learn(self) -> None:
        """Encodes the new words, many at once: behind each other they are cut as they are alone, but for words that end in white space."""
        new, self.known.new = self.known.new, []
        self.odd = np.append(self.odd, np.zeros(len(new), bool))
        word = len(self.known) - len(new)
        at = 0
        while at < len(new):
            stop = at
            while self.by_word and stop < len(new) and stop - at < TOGETHER and len(new[stop]) <= LONGEST and not new[stop][-1].isspace():
                stop += 1
            some = new[at:max(stop, at + 1)]
            whole = "".join(some)
            if stop > at:
                ids = self.tok.encode_batch_fast([whole], add_special_tokens=False)[0].ids, self.sp.encode(whole[1:])
            if stop > at and self.joins(whole.encode(), *ids):
                ends = np.cumsum([len(w.encode()) for w in some])
                for pool, own, length in ((self.pool_a, ids[0], self.len_a), (self.pool_b, ids[1], self.len_b)):
                    own = np.array(own, np.int64)
                    pool.add(word + at, own, np.diff(np.searchsorted(np.cumsum(length[own]), ends) + 1, prepend=0))
            else:
                for k, w in enumerate(some):
                    ids = self.one(w)
                    self.odd[word + at + k] = not self.joins(w.encode(), *ids)
                    for pool, own in zip((self.pool_a, self.pool_b), ids):
                        pool.add(word + at + k, np.array(own, np.int64), np.array([len(own)]))
            self.held += 160 * len(some) + 5 * len(whole)
            at += len(some)

    def joins(self, whole: bytes, *ids) -> bool:
        return all(b"".join([table[i] for i in own]) == whole for table, own in zip((self.bytes_a, self.bytes_b), ids))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The ids of A and of B of all texts, end to end, and their numbers by text."""
        if self.held > WORD_BYTES:
            self.forget()
        number = self.known.__getitem__
        each = [np.fromiter(map(number, self.cut(t)), np.int64) if t else np.zeros(0, np.int64) for t in texts]
        self.learn()
        words, first = np.concatenate([*each, np.zeros(0, np.int64)]), np.concatenate([[0], np.cumsum([len(w) for w in each], dtype=np.int64)])
        (a, n_a), (b, n_b) = self.pool_a.take(words), self.pool_b.take(words)
        n_a, n_b = per_text(n_a, first), per_text(n_b, first)
        odd = np.flatnonzero(per_text(self.odd[words], first))
        if len(odd):
            first_a, first_b = (np.concatenate([[0], np.cumsum(n)]) for n in (n_a, n_b))
            gone = [t for t in odd if not self.joins(f" {texts[t]}".encode(), a[first_a[t]:first_a[t + 1]], b[first_b[t]:first_b[t + 1]])]
            kept = np.ones(len(texts), bool)
            kept[gone] = False
            a, b = a[np.repeat(kept, n_a)], b[np.repeat(kept, n_b)]
            n_a, n_b = n_a * kept, n_b * kept
        return a, b, n_a, n_b


@lru_cache(2)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


# ---------------------------------------------------------------------------
# Spark
# ---------------------------------------------------------------------------

ENCODED = "row long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a array<int>, b array<int>, n array<long>, pairs boolean"


class PairCounts:
    """Links by pair of ids (``a << 32 | b``), merged once too many lie about."""

    def __init__(self):
        self.parts, self.loose = [], 0

    def add(self, codes: np.ndarray) -> None:
        self.parts.append(np.unique(codes, return_counts=True))
        self.loose += len(self.parts[-1][0])

    def merge(self) -> int:
        if len(self.parts) > 1:
            codes, at = np.unique(np.concatenate([p[0] for p in self.parts]), return_inverse=True)
            n = np.zeros(len(codes), np.int64)
            np.add.at(n, at, np.concatenate([p[1] for p in self.parts]))
            self.parts = [(codes, n)]
        self.loose = len(self.parts[0][0]) if self.parts else 0
        return self.loose

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        self.merge()
        out = self.parts[0] if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        self.parts, self.loose = [], 0
        return out


def _lists(values: np.ndarray, n: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(values.astype(kind)))


def encoded(docs: DataFrame, id_col: str, text_col: str, path_a: str, path_b: str) -> str:
    """Writes a row of tokens and groups for each text, and rows of pair counts for each task (``pairs``); returns the folder."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v, counts = vocabularies(path_a, path_b), PairCounts()
        row, ids = TaskContext.get().partitionId() << 33, None

        def handed() -> pa.RecordBatch:
            codes, n = counts.take()
            none = pa.nulls(1, pa.int64())
            size = np.array([len(codes)])
            return pa.RecordBatch.from_arrays(
                [pa.nulls(1, ids), none, none, none, none, none, pa.nulls(1, pa.string()), _lists(codes >> 32, size, np.int32), _lists(codes & 0xFFFFFFFF, size, np.int32),
                 _lists(n, size, np.int64), pa.array([True])], names=names)

        names = ["doc_id", *[c.split()[0] for c in ENCODED.split(", ")]]
        for batch in batches:
            ids = batch.schema.field(0).type
            # Texts in runs of bounded size: their tokens' arrays are some 100 bytes for each byte of text.
            sizes = np.cumsum(pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) // RUN_BYTES
            for s, e in zip(*(lambda h: (h, np.append(h[1:], batch.num_rows)))(np.flatnonzero(np.diff(sizes, prepend=-1)))):
                part = batch.slice(s, e - s)
                found = Aligned(*v.encode(part.column(1).to_pylist()), v.len_a, v.len_b)
                _, a, b = found.links()
                counts.add(a << 32 | b)
                sha = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found.group_texts(v.words, len(v.bytes_a))]
                m = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.arange(row, row + m)), *[pa.array(x) for x in (found.n_a, found.n_b, found.n_groups, found.n_links)], pa.array(sha, pa.string()),
                     _lists(found.a, found.n_a, np.int32), _lists(found.b, found.n_b, np.int32), pa.nulls(m, pa.list_(pa.int64())), pa.array([False] * m)], names=names)
                row += m
                if counts.loose > PAIRS_KEPT and counts.merge() > PAIRS_KEPT // 2:
                    yield handed()
        if counts.loose:
            yield handed()

    out = arrow_map(docs.select(F.col(id_col).alias("doc_id"), empty_text(text_col).alias("text")), run, f"doc_id {id_type}, {ENCODED}")
    path = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/riskgrid-tables/{docs.sparkSession.sparkContext.applicationId}/alignment-{uuid.uuid4().hex}"
    out.write.option("compression", "zstd").partitionBy("pairs").parquet(path)
    return path


#: Bytes of text aligned at a time (a longer text is aligned alone).
RUN_BYTES = 1 << 20


def pair_counts(tokens: DataFrame) -> DataFrame:
    """``a, b, n`` over the whole corpus, from the tasks' counts."""
    each = tokens.where("pairs").select(F.explode(F.arrays_zip("a", "b", "n")).alias("p")).select("p.*")
    return each.groupBy("a", "b").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row."""
    from riskgrid.llm.common import materialize

    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    path = encoded(docs, id_col, text_col, path_a, path_b)
    tokens = spark.read.schema(f"doc_id {id_type}, {ENCODED}").parquet(path)
    counts = materialize(pair_counts(tokens), "alignment-pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    rows = tokens.where("NOT pairs")
    report = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    often = counts.where("n > 1")
    if often.count() > PAIRS_SENT:
        return by_join(rows, counts.join(most, "b"), path_a, path_b).select(*report, "n_best", "count_sum", "groups_sha256")
    sent = often.select((F.shiftleft(F.col("a").cast("long"), 32) + F.col("b")).alias("code"), "n").toArrow()
    code, n = (sent.column(k).to_numpy().astype(np.int64) for k in (0, 1))
    order = np.argsort(code)
    top = most.where("most > 1").toArrow()  # at most B's vocabulary
    table = spark.sparkContext.broadcast((code[order], n[order], *(top.column(k).to_numpy().astype(np.int64) for k in (0, 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(path_a, path_b)
        code, n, b_id, b_most = table.value
        code, n = np.append(code, np.int64(2**62)), np.append(n, 1)
        most = np.ones(len(v.bytes_b), np.int64)
        most[b_id] = b_most
        for batch in batches:
            text, a, b, m = stored_links(batch, v)
            c = a << 32 | b
            at = np.searchsorted(code, c)
            n_link = np.where(code[at] == c, n[at], 1)
            best, total = np.zeros(m, np.int64), np.zeros(m, np.int64)
            np.add.at(best, text, n_link == most[b])
            np.add.at(total, text, n_link)
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in range(5)], pa.array(best), pa.array(total), batch.column(5)],
                                             names=[*report, "n_best", "count_sum", "groups_sha256"])

    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return arrow_map(rows.select(*report, "groups_sha256", "a", "b"), run, schema)


def stored_links(batch: pa.RecordBatch, v: Vocabularies) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(text, A id, B id) of the links of written rows, whose last two columns are their tokens; and the number of rows."""
    lists = [batch.column(batch.num_columns - k) for k in (2, 1)]
    n = [pa.compute.list_value_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
    ids = [x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
    return *Tokens(*ids, *n, v.len_a, v.len_b).links(), batch.num_rows


def by_join(rows: DataFrame, counts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The same for any number of pairs: the texts' distinct pairs meet the counts by shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(path_a, path_b)
        for batch in batches:
            text, a, b, m = stored_links(batch, v)
            row = batch.column(0).to_numpy()
            order = np.lexsort((b, a, text))
            text, a, b = text[order], a[order], b[order]
            head = np.flatnonzero(np.diff(text, prepend=-1) | np.diff(a, prepend=-1) | np.diff(b, prepend=-1))
            times = np.diff(np.append(head, len(text)))
            yield pa.RecordBatch.from_arrays([pa.array(row[text[head]]), pa.array(a[head].astype(np.int32)), pa.array(b[head].astype(np.int32)), pa.array(times)],
                                             names=["row", "a", "b", "times"])

    own = arrow_map(rows.select("row", "a", "b"), run, "row long, a int, b int, times long")
    met = own.join(counts, ["a", "b"]).groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("most"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return rows.join(met, "row", "left").fillna(0, ["n_best", "count_sum"])
